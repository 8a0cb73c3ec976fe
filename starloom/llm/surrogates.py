"""Personal data replaced by keyed surrogates of the same kind.

Found are e-mail addresses, IP addresses, phone, card, social security and bank account numbers,
keys and passwords, and names with a title or a common given name. The texts are cut at one
pattern; entities are written in a normal form (digits only, one letter case, phones with their
country code), so that an entity has one surrogate in the whole corpus, however it is written. The surrogate is drawn from
SHA-256 of (key, kind, normal form, attempt): digits for digits, letters for letters of the same
script, and so on; a name's given name keeps its gender; titles, country codes, the first digit
and the check digit rule of cards and the prefixes of keys stay. A surrogate that another entity
has drawn, or that is itself an entity of the corpus, is drawn again, until all are distinct.

Only entities and the documents that hold some are shuffled. Each distinct entity is drawn once,
whatever the number of documents that hold it.

Defined cases: a null text stays null, a text without entities stays as it is. Rows that repeat
are replaced alike. An empty table gives an empty result. Extra columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.session import written

KEY = "surrogate-key"  # production sets its own
ATTEMPTS = 64
DRAWS = 4000  # normal forms that one task draws

# Titles and given names by gender, syllables by script.
TITLES = {"m": "Mr Herr Monsieur Señor Sr господин", "f": "Mrs Ms Miss Frau Madame Señora Sra госпожа",
          "": "Dr Prof"}
GIVEN = {
    "m": "John James Michael Robert David William Peter Thomas Hans Jürgen Klaus Pierre Jacques José "
         "Carlos Javier Иван Дмитрий Сергей",
    "f": "Mary Patricia Jennifer Susan Sarah Emily Elizabeth Ursula Sabine Amélie Chloé María Carmen "
         "Lucía Анна Елена Ольга",
}
LATIN = ("ba be bo da de do fa fe ga go ha he ja jo ka ke ko la le lo ma me mo na ne no pa pe po ra re ro "
         "sa se so ta te to va ve vo").split()
CYRILLIC = "ба бе бо ва ве во га го да де до за зе ка ко ла ле ло ма ме мо на не но па по ра ре ро са се".split()
ENDING = {("latin", "m"): "n", ("latin", "f"): "la", ("latin", ""): "ri", ("latin", "s"): "ner",
          ("cyrillic", "m"): "н", ("cyrillic", "f"): "ла", ("cyrillic", ""): "ри", ("cyrillic", "s"): "нко"}

# Country codes of one and two digits; all others have three.
COUNTRY_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
                 "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98")

_ALL_TITLES = "|".join(" ".join(TITLES.values()).split())
_ALL_GIVEN = "|".join(" ".join(GIVEN.values()).split())
_BEGIN, _STOP = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_WORD = r"\p{Lu}\p{L}+"
PARTS = [
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    # after a colon, as in prose, only what has a digit or a sign inside
    r"(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey) ?[=:] ?[\"']?)"
    r"(?:(?<==)|(?<== )|(?<=[\"'])|(?=\p{L}*[^\p{L}\s\"'][^\s\"']*[\p{L}\p{N}]))[^\s\"']{6,}+",
    rf"{_BEGIN}(?:AKIA|ASIA)[A-Z0-9]{{16}}{_STOP}",
    rf"{_BEGIN}(?:sk|pk|gh[opsu]|xox[abp])[-_][A-Za-z0-9_-]{{16,}}+",
    rf"{_BEGIN}eyJ[A-Za-z0-9_-]{{8,}}+(?:\.[A-Za-z0-9_-]++){{1,2}}",
    rf"{_BEGIN}[0-9a-fA-F]{{32,}}+{_STOP}",
    r"(?<![\p{L}\p{N}.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\d)",
    r"(?<![\p{L}\p{N}:])[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){7}(?![\p{L}\p{N}:])",
    rf"{_BEGIN}[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_STOP}",
    rf"{_BEGIN}\d{{3}}-\d{{2}}-\d{{4}}{_STOP}",
    rf"{_BEGIN}(?:\d{{13,19}}|\d{{4}}(?:[ -]\d{{4}}){{3}}){_STOP}",
    r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)",
    r"(?<![\p{L}\p{N}+])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\p{L}\p{N}.+-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d)",
    rf"{_BEGIN}(?:(?:{_ALL_TITLES})\.? {_WORD}(?: {_WORD}){{0,2}}|(?:{_ALL_GIVEN})(?: {_WORD})?){_STOP}",
]
ENTITY = "|".join(PARTS)
_NAMES = f"{_ALL_TITLES}|{_ALL_GIVEN}"
# The first letter is tested before the words, which most places fail.
NAME_HINT = rf"(?=[{''.join(sorted({w[0] for w in _NAMES.split('|')}))}]){_BEGIN}(?:{_NAMES})"
_KEPT = r"^(?:akia|asia|AKIA|ASIA|(?:sk|pk|gh[opsu]|xox[abp])[-_]|eyJ)"


def hinted(text: Column) -> Column:
    """What every text with an entity has, and is cheaper to look for than the entities."""
    found = text.rlike("[0-9@=:_-]") | text.rlike("[a-fA-F]{32}") | text.rlike(NAME_HINT)
    for prefix in ("AKIA", "ASIA", "eyJ"):
        found = found | text.contains(prefix)
    return F.coalesce(found, F.lit(False))


def kind_of(value: Column) -> Column:
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
        .when(value.rlike(r"^[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){7}$"), "ipv6")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(value.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$"), "account")
        .when(value.rlike(r"^\+\d|^\(\d{3}\)|^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
        .when(value.rlike(r"^(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})$"), "card")
        .when(value.rlike(rf"^(?:(?:{_ALL_TITLES})\.? {_WORD}(?: {_WORD}){{0,2}}|(?:{_ALL_GIVEN})(?: {_WORD})?)$"),
              "name")
        .otherwise("secret")
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _country(value: Column) -> Column:
    """`+` and the country code, however the digits are divided."""
    return F.regexp_extract(value, rf"^\+(?:{COUNTRY_CODES.replace(' ', '|')}|\d{{3}})", 0)


def normal(kind: Column, value: Column) -> Column:
    body = F.substr(value, F.length(_country(value)) + 1)
    one_case = (value == F.lower(value)) | (value == F.upper(value)) | (kind == "email")
    # ten digits in groups of three, three and four, without a code, are a number of country 1
    code = F.when(value.startswith("+"), _country(value)).otherwise("+1")
    return (
        F.when(kind == "phone", F.concat(code, F.lit("|"), _digits(body)))
        .when(kind.isin("card", "ssn"), _digits(value))
        .when(kind == "account", F.replace(value, F.lit(" "), F.lit("")))
        .otherwise(F.when(one_case, F.lower(value)).otherwise(value))
    )


def _pick(words: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (number % len(words) + 1).cast("int"))


def units(kind: Column, value: Column) -> Column:
    """What gets a surrogate of its own: the whole, or each part of a name as `given.gender` or
    `surname`. Titles have an empty kind."""
    parts = F.split(value, " ")

    def is_in(x: Column, words: str) -> Column:
        return F.lower(x).isin(*words.lower().split())

    title = F.regexp_replace(F.get(parts, F.lit(0)), r"\.$", "")
    titled = is_in(title, _ALL_TITLES.replace("|", " "))
    by_title = F.when(is_in(title, TITLES["m"]), "m").when(is_in(title, TITLES["f"]), "f").otherwise("")

    def part(x: Column, i: Column) -> Column:
        gender = F.when(is_in(x, GIVEN["m"]), "m").when(is_in(x, GIVEN["f"]), "f").otherwise(by_title)
        known = is_in(x, " ".join(GIVEN.values()))
        last = (i == F.size(parts) - 1) & ((i > 0) | ~known) & ~((i == 1) & titled & known)
        name = F.when(last, F.lit("surname")).otherwise(F.concat(F.lit("given."), gender))
        return F.struct(F.when(titled & (i == 0), F.lit("")).otherwise(name).alias("kind"),
                        F.lower(x).alias("normal"))

    whole = F.array(F.struct(kind.alias("kind"), normal(kind, value).alias("normal")))
    return F.when(kind == "name", F.transform(parts, part)).otherwise(whole)


def drawn(kind: Column, text: Column, attempt: int) -> Column:
    """The surrogate of a normal form, in normal form, from the hash digits in `_stream`."""
    stream = F.col("_stream")

    def number(i: Column) -> Column:
        """0 to 65535 for place i."""
        at = (i % 64 * 4 + 1).cast("int")
        return F.conv(F.substr(stream, at, F.lit(4)), 16, 10).cast("int")

    kept = (
        F.when(kind == "phone", F.instr(text, "|"))
        .when(kind == "card", F.lit(1))
        .when(kind == "account", F.lit(2))
        .when(kind == "secret", F.length(F.regexp_extract(text, _KEPT, 0)))
        .otherwise(F.lit(0))
    )
    top = F.when(kind == "email", F.length(F.regexp_extract(text, r"\.[^.]*$", 0))).otherwise(F.lit(0))
    hexed = (kind.isin("secret", "ipv6")) & text.rlike("^[0-9a-f:]+$")

    def char(c: Column, i: Column) -> Column:
        n = number(i)
        return (
            F.when((i < kept) | (i >= F.length(text) - top), c)
            .when(hexed & c.rlike("[0-9a-f]"), F.substr(F.lit("0123456789abcdef"), n % 16 + 1, F.lit(1)))
            .when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substr(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), n % 27 + 1, F.lit(1)))
            .when(c.rlike(r"\p{Lu}"), F.char(F.lit(65) + n % 26))
            .when(c.rlike(r"\p{L}"), F.char(F.lit(97) + n % 26))
            .otherwise(c)
        )

    plain = F.array_join(F.transform(F.split(text, ""), char), "")
    octets = F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i == 0, number(i) % 223 + 1).otherwise(number(i) % 256)
        .cast("string")), ".")
    front = F.substr(plain, F.lit(1), F.length(text) - 1)
    check = (F.lit(10) - luhn(F.concat(front, F.lit("0"))) % 10) % 10
    card = F.when(luhn(text) % 10 == 0, F.concat(front, check.cast("string"))).otherwise(plain)

    def name(script: str, role: str) -> Column:
        count = (4 if role == "s" else 3) + attempt
        syllables = LATIN if script == "latin" else CYRILLIC
        parts = [_pick(syllables, number(F.lit(k))) for k in range(count)]
        return F.concat(*parts, F.lit(ENDING[script, role]))

    cyrillic = text.rlike(r"\p{IsCyrillic}")
    names = [(F.lit("surname"), "s"), (F.lit("given.m"), "m"), (F.lit("given.f"), "f"), (F.lit("given."), "")]
    out = F.when(kind == "ip", octets).when(kind == "card", card)
    out = reduce(lambda acc, x: acc.when(
        kind == x[0], F.when(cyrillic, name("cyrillic", x[1])).otherwise(name("latin", x[1]))), names, out)
    return out.otherwise(plain)


def luhn(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled."""
    size = F.length(digits)

    def one(acc: Column, i: Column) -> Column:
        d = F.substr(digits, size - i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), F.lit(0), one)


def draw_all(forms: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, normal, surrogate) of distinct normal forms: all surrogates of a kind distinct, and
    none a normal form of that kind. The smallest form of those that draw alike keeps its draw.
    """
    left, done = forms, None
    taken = forms.select("kind", F.col("normal").alias("surrogate"))
    for attempt in range(ATTEMPTS):
        seed = F.concat_ws("\x1f", F.lit(key), "kind", "normal", F.lit(str(attempt)))
        stream = F.concat(*[F.sha2(F.concat(seed, F.lit(f"\x1f{k}")), 256) for k in range(4)])
        count = left.count()
        if not count and done is not None:
            return done
        # a draw is work on a few bytes: dealt by rows, as parts by bytes would be one task
        dealt = left.repartition(max(1, -(-count // DRAWS)), "kind", "normal")
        new = dealt.withColumn("_stream", stream).select(
            "kind", "normal", drawn(F.col("kind"), F.col("normal"), attempt).alias("surrogate"))
        new = written(new, "drawn")
        first = new.groupBy("kind", "surrogate").agg(F.min("normal").alias("normal"))
        free = first.join(taken, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        free = written(free.select("kind", "normal", "surrogate"), "free")
        done = free if done is None else done.unionByName(free)
        left = written(left.join(free, ["kind", "normal"], "left_anti"), "left")
    if not left.limit(1).count():
        return done
    raise ValueError(f"some entities have no free surrogate of their format after {ATTEMPTS} draws")


def _filled(pattern: Column, text: Column, replaced: str) -> Column:
    """`pattern` with its characters of the class `replaced` taken from `text` one by one."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(a: Column, c: Column) -> Column:
        hit = c.rlike(replaced)
        return F.struct(
            F.concat(a["out"], F.when(hit, F.substr(text, a["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (a["k"] + hit.cast("int")).alias("k"))

    return F.aggregate(F.split(pattern, ""), state, step)["out"]


def _cased(text: Column, pattern: Column) -> Column:
    """`text` with capitals where the pattern has them."""
    return F.array_join(F.zip_with(
        F.split(text, ""), F.split(pattern, ""),
        lambda c, p: F.when(p != F.lower(p), F.upper(c)).otherwise(F.coalesce(c, F.lit("")))), "")


def replacement(kind: Column, value: Column, surrogates: Column) -> Column:
    """The surrogate as the value was written. `surrogates`: of its units, null for a title."""
    first = F.get(surrogates, F.lit(0))
    country = _country(value)
    body = F.substr(value, F.length(country) + 1)
    big = (value == F.upper(value)) & (value != F.lower(value))
    parts = F.zip_with(F.split(value, " "), surrogates, lambda x, s: F.when(s.isNull(), x).otherwise(
        F.when(x == F.upper(x), F.upper(s)).otherwise(F.initcap(s))))
    return (
        F.when(kind == "name", F.array_join(parts, " "))
        .when(kind == "phone", F.concat(country, _filled(body, F.substring_index(first, "|", -1), r"\d")))
        .when(kind == "email", _cased(first, value))
        .when(kind.isin("card", "ssn"), _filled(value, first, r"\d"))
        .when(kind == "account", _filled(value, first, "[^ ]"))
        .otherwise(F.when(big, F.upper(first)).otherwise(first))
    )


def entities(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The documents with surrogates, their columns and `n_entities`, which replaces such a column.

    Other columns of any name are carried along.
    """
    columns = [c for c in docs.columns if c.lower() != "n_entities"]
    rest = [c for c in columns if c != "text"]
    docs = docs.select("text", F.struct(*rest).alias("_rest")) if rest else docs.select("text", F.lit(None).alias("_rest"))
    hint = hinted(F.col("text"))
    seen = docs.where(hint).withColumn("_found", entities(F.col("text")))
    held = written(
        seen.where(F.size("_found") > 0)
        .withColumn("_pieces", F.split("text", ENTITY, -1))
        .withColumn("_row", F.xxhash64(F.md5("text"), "text"))
        .drop("text"),
        "held",
    )
    places = held.select("_row", F.posexplode("_found").alias("at", "value")).distinct()
    values = held.select(F.explode("_found").alias("value")).distinct()
    values = values.withColumn("kind", kind_of(F.col("value")))
    values = values.withColumn("units", units(F.col("kind"), F.col("value")))
    each = written(values.select("value", F.col("kind").alias("of"), F.posexplode("units").alias("n", "unit")), "units")
    each = each.select("value", "of", "n", "unit.kind", "unit.normal")
    draws = draw_all(each.where("kind <> ''").select("kind", "normal").distinct(), key)
    parts = each.join(draws, ["kind", "normal"], "left")
    whole = parts.groupBy("value", "of").agg(
        F.array_sort(F.collect_list(F.struct("n", "surrogate"))).alias("s"))
    new = replacement(F.col("of"), F.col("value"), F.transform("s", lambda x: x["surrogate"]))
    table = written(whole.select("value", new.alias("new")), "replacements")
    lists = places.join(table, "value").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("at", "new"))).alias("new"))
    filled = F.zip_with(
        "_pieces", F.transform("new", lambda x: x["new"]), lambda p, n: F.concat(p, F.coalesce(n, F.lit(""))))
    done = held.join(lists, "_row").select(
        F.array_join(filled, "").alias("text"), "_rest", F.size("_found").cast("bigint").alias("n_entities"))
    none = ~hint | ~F.col("text").rlike(ENTITY)
    same = docs.where(none).select("text", "_rest", F.lit(0).cast("bigint").alias("n_entities"))
    both = same.unionByName(done)
    return both.select(*["text" if c == "text" else F.col(f"_rest.`{c}`") for c in columns], "n_entities")
