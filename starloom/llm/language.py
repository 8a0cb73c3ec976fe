"""Language of a text, by a convolutional network over bytes.

Filters of several widths slide over windows of a fixed number of bytes; the largest answer of
each filter in a window feeds a softmax over the languages. As the input of a filter is one of
256 bytes at each place, its weights are a table per place, and a window costs table look-ups
only; the tables of two neighbouring places are joined for prediction. Training (numpy, Adam) is
on windows of a bounded sample of labelled texts. Prediction covers all windows of a text; a
text's probabilities are the mean of its windows'.

The sample: the distinct texts of lowest keyed hash, PER_LANGUAGE of each language, and of each
WINDOWS windows at keyed places. Copies of a text in a language are one. With more than LANGUAGES
languages, each has fewer texts (SAMPLE in all), but at least one. The sample and the number of
texts of each language are all that comes to the driver.

Defined cases: null texts and texts without letters are `und` with score 0. Texts shorter than a
window are padded with zero bytes. Null and blank languages are no labels. Without any label all
texts are `und`. Equal probabilities: the language that sorts first. Repeated rows are predicted
each. Extra columns are kept by `keep_known` and ignored by `predicted`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.shingles import _bytes

WIDTHS, FILTERS, WINDOW = (2, 3, 4, 5), 8, 128
PER_LANGUAGE, LANGUAGES, WINDOWS, EPOCHS = 600, 200, 4, 12
SAMPLE = PER_LANGUAGE * LANGUAGES
STEPS = 100  # of training at least, however few the texts
REJECT = 0.35  # a text whose best language is less likely than this is rejected
UND = "und"
ROWS = 4096  # windows at once


@dataclass
class Model:
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray  # (filters of all widths,)
    out: np.ndarray  # (filters of all widths + 1, languages)

    def paired(self) -> list[list[tuple[int, bool, np.ndarray]]]:
        """Per width: (place, two bytes?, table)."""
        result = []
        for t in self.tables:
            parts, k = [], 0
            while k < len(t):
                if k + 1 < len(t):
                    both = (t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, FILTERS)
                    parts.append((k, True, np.ascontiguousarray(both)))
                    k += 2
                else:
                    parts.append((k, False, t[k]))
                    k += 1
            result.append(parts)
        return result


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(x: np.ndarray, paired, bias: np.ndarray) -> np.ndarray:
    """Largest answer of each filter in windows of bytes (n, WINDOW)."""
    two = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
    found = []
    for width, parts in zip(WIDTHS, paired):
        size = WINDOW - width + 1
        total = None
        for k, double, t in parts:
            part = t[two[:, k:k + size]] if double else t[x[:, k:k + size]]
            total = part if total is None else np.add(total, part, out=total)
        found.append(total.max(axis=1))
    return np.maximum(np.concatenate(found, axis=1) + bias, 0)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 3) -> Model:
    """Fit to windows of bytes (n, WINDOW) with label numbers; languages weigh alike."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    params = [rng.normal(0, 0.3 / w**0.5, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    params += [np.zeros(n_filters, np.float32),
               rng.normal(0, 0.3, (n_filters + 1, len(languages))).astype(np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.bincount(labels, minlength=len(languages)).astype(np.float64)
    weight = len(labels) / np.maximum(share, 1) / max((share > 0).sum(), 1)
    step = 0
    for _ in range(max(EPOCHS, -(-STEPS // max(-(-len(labels) // 64), 1)))):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), 64):
            rows = order[at:at + 64]
            x, y = windows[rows], labels[rows]
            peaks, answers = [], []
            for width, t in zip(WIDTHS, params):
                size = WINDOW - width + 1
                total = t[0][x[:, :size]]
                for k in range(1, width):
                    total = total + t[k][x[:, k:k + size]]
                peaks.append(total.argmax(axis=1))
                answers.append(total.max(axis=1))
            z = np.concatenate(answers, axis=1) + params[-2]
            h = np.maximum(z, 0)
            wide = np.concatenate([h, np.ones((len(rows), 1), np.float32)], axis=1)
            p = _softmax(wide @ params[-1])
            p[np.arange(len(rows)), y] -= 1
            p = (p * weight[y][:, None] / len(rows)).astype(np.float32)
            back = (p @ params[-1][:-1].T) * (z > 0)
            grads = [np.zeros_like(q) for q in params]
            grads[-1], grads[-2] = wide.T @ p, back.sum(axis=0)
            for g, (width, peak) in enumerate(zip(WIDTHS, peaks)):
                part = back[:, g * FILTERS:(g + 1) * FILTERS]
                f = np.broadcast_to(np.arange(FILTERS), peak.shape)
                for k in range(width):
                    seen = x[np.arange(len(rows))[:, None], peak + k]
                    np.add.at(grads[g][k], (seen, f), part)
            step += 1
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                rate = 0.01 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                params[k] = (params[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return Model(languages, params[:-2], params[-2], params[-1])


def _windows(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every window, and the text of each."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return offsets[text] + number * WINDOW, text


def _cut(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Windows of WINDOW bytes, zero beyond the end of their text."""
    at = starts[:, None] + np.arange(WINDOW)
    out = raw[np.minimum(at, len(raw) - 1)]
    out[at >= ends[:, None]] = 0
    return out


def probabilities(texts: pa.Array, model: Model, paired) -> np.ndarray:
    """Mean probability of each language over the windows of each text."""
    offsets, raw = _bytes(texts)
    total = np.zeros((len(texts), len(model.languages)))
    starts, text = _windows(offsets, raw)
    for at in range(0, len(starts), ROWS):
        s, t = starts[at:at + ROWS], text[at:at + ROWS]
        h = _features(_cut(raw, s, offsets[t + 1]), paired, model.bias)
        p = _softmax(h @ model.out[:-1] + model.out[-1])
        for k in range(p.shape[1]):
            total[:, k] += np.bincount(t, weights=p[:, k], minlength=len(texts))
    count = np.bincount(text, minlength=len(texts)) if len(text) else np.zeros(len(texts))
    return total / np.maximum(count, 1)[:, None]


def fit(labelled: DataFrame, seed: str = "language") -> Model:
    """Train on a bounded sample of (text, lang)."""
    rows = labelled.where("lang IS NOT NULL AND trim(lang) <> '' AND text IS NOT NULL AND text <> ''")
    h = F.xxhash64(F.lit(seed), F.md5("text"))
    counts = rows.select("lang", h.alias("h")).distinct().groupBy("lang").count().collect()
    if not counts:
        return Model([], [], np.zeros(0), np.zeros((1, 0)))
    each = max(min(PER_LANGUAGE, SAMPLE // len(counts)), 1)
    # A fraction of the hash range gives each language about twice its number, or all if it has few.
    few = 2 * each + 30
    shares = F.map_from_arrays(F.lit([r["lang"] for r in counts]), F.lit(
        [min(1.0, few / r["count"]) for r in counts]))
    thin = rows.where((F.pmod(h, F.lit(1 << 20)) / F.lit(float(1 << 20))) < F.element_at(shares, F.col("lang")))
    size = F.length("text")
    parts = F.array(*[
        F.substr(F.col("text"), (F.lit(1) + F.pmod(F.xxhash64(h, F.lit(k)), F.greatest(
            size - WINDOW + 1, F.lit(1)))).cast("int"), F.lit(WINDOW)) for k in range(WINDOWS)])
    once = thin.select("lang", h.alias("h"), parts.alias("parts")).groupBy("lang", "h").agg(
        F.first("parts").alias("parts"))
    sample = sorted(once.collect(), key=lambda r: (r["h"], r["lang"]))
    taken: dict[str, int] = {}
    windows, labels = [], []
    languages = sorted({r["lang"] for r in sample})
    number = {lang: k for k, lang in enumerate(languages)}
    for r in sample:
        if taken.setdefault(r["lang"], 0) < each:
            taken[r["lang"]] += 1
            for part in r["parts"]:
                windows.append(part.encode()[:WINDOW].ljust(WINDOW, b"\0"))
                labels.append(number[r["lang"]])
    x = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array(labels), languages)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predicted(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns in `keep`, with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = docs.select(*keep).schema.fields
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def predict(batches):
        model = shared.value
        paired = model.paired()
        for batch in batches:
            texts, letters = batch.column(len(keep)), pc.fill_null(batch.column(len(keep) + 1), False)
            known = letters.to_numpy(zero_copy_only=False)
            names, score = np.full(len(texts), UND, object), np.zeros(len(texts))
            if model.languages:
                p = probabilities(texts, model, paired)
                best = p.argmax(axis=1)
                names[known] = np.array(model.languages, object)[best[known]]
                score[known] = p.max(axis=1)[known].clip(0, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(names, pa.string()), pa.array(score)],
                [*keep, "lang_pred", "score"],
            )

    rows = docs.select(*keep, F.col("text").alias("_text"), has_letters(F.col("text")).alias("_letters"))
    return rows.mapInArrow(predict, f"{ddl}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """Documents whose language is known with some confidence; all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def choose(batches):
        model = shared.value
        paired = model.paired()
        for batch in batches:
            keep = pc.fill_null(batch.column(len(docs_columns)), False).to_numpy(zero_copy_only=False)
            if model.languages:
                keep = keep & (probabilities(batch.column(text), model, paired).max(axis=1) >= REJECT)
            yield batch.select(docs_columns).filter(pa.array(keep))

    docs_columns, schema = docs.columns, docs.schema
    return docs.withColumn("_letters", has_letters(F.col("text"))).mapInArrow(choose, schema)
