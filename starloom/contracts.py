"""Declared shape of tables: columns, keys, ranges, lengths and layout.

Reads pass the schema of a contract, so there is no inference pass. Constraints are verified
by Spark jobs (`operators.quality`), not enforced by storage.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: str  # DDL, e.g. "user_id int, level string"
    not_null: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)  # col -> (table, col)
    checks: dict[str, str] = field(default_factory=dict)  # check name -> SQL predicate
    max_length: dict[str, int] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def column_names(self) -> list[str]:
        return self.schema.fieldNames()

    def conform(self, df: DataFrame) -> DataFrame:
        """Columns of the contract, in its order and types."""
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])


# --- play log and song catalog, as they arrive ---

PLAY_LOG = TableContract(
    "play_log",
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId bigint, song string, status int, "
    "ts bigint, userAgent string, userId string",
)

SONG_CATALOG = TableContract(
    "song_catalog",
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, "
    "duration double, year int",
)

EVENT_CSV = TableContract(
    "event_csv",
    "artist string, auth string, firstName string, gender string, itemInSession string, "
    "lastName string, length string, level string, location string, method string, "
    "page string, registration string, sessionId string, song string, status string, "
    "ts string, userId string",
)

STAGED_EVENTS = TableContract(
    "staging_events",
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length decimal(15,5), level string, location string, method string, "
    "page string, registration bigint, sessionId bigint, song string, status int, "
    "ts bigint, userAgent string, userId bigint",
    not_null=("auth", "itemInSession", "level", "method", "page", "sessionId", "status", "ts"),
    max_length={
        "artist": 256, "auth": 30, "firstName": 64, "gender": 1, "lastName": 64, "level": 4,
        "location": 128, "method": 6, "page": 30, "song": 256, "userAgent": 256,
    },
    cluster_by=("sessionId",),
    sort_by=("song",),
)

STAGED_SONGS = TableContract(
    "staging_songs",
    "artist_id string, artist_latitude decimal(15,5), artist_location string, "
    "artist_longitude decimal(15,5), artist_name string, duration decimal(15,5), "
    "num_songs int, song_id string, title string, year int",
    not_null=("artist_id", "artist_name", "duration", "num_songs", "song_id", "title", "year"),
    max_length={
        "artist_id": 18, "artist_location": 128, "artist_name": 256, "song_id": 18, "title": 256,
    },
    cluster_by=("song_id",),
    sort_by=("title",),
)

# --- play star ---

USERS = TableContract(
    "users",
    "user_id int, first_name string, last_name string, gender string, level string",
    not_null=("user_id", "first_name", "last_name", "gender", "level"),
    primary_key=("user_id",),
    max_length={"first_name": 64, "last_name": 64, "gender": 1, "level": 4},
    cluster_by=("user_id",),
    sort_by=("user_id",),
)

ARTISTS = TableContract(
    "artists",
    "artist_id string, artist_name string, artist_location string, "
    "artist_latitude decimal(15,5), artist_longitude decimal(15,5)",
    not_null=("artist_id", "artist_name"),
    primary_key=("artist_id",),
    checks={
        "latitude_range": "isnan(double(artist_latitude)) OR artist_latitude BETWEEN -90 AND 90",
        "longitude_range":
            "isnan(double(artist_longitude)) OR artist_longitude BETWEEN -180 AND 180",
    },
    max_length={"artist_id": 18, "artist_name": 256, "artist_location": 128},
    sort_by=("artist_id",),
)

SONGS = TableContract(
    "songs",
    "song_id string, title string, artist_id string, year int, duration decimal(15,5)",
    not_null=("song_id", "title", "artist_id", "year", "duration"),
    primary_key=("song_id",),
    foreign_keys={"artist_id": ("artists", "artist_id")},
    checks={"year_range": "year >= 0", "duration_range": "duration > 0"},
    max_length={"song_id": 18, "title": 256, "artist_id": 18},
    partition_by=("year",),
    sort_by=("artist_id", "song_id"),
)

TIMES = TableContract(
    "times",
    "start_time timestamp_ntz, hour int, day int, week int, month int, year int, weekday int",
    not_null=("start_time", "hour", "day", "week", "month", "year", "weekday"),
    primary_key=("start_time",),
    checks={
        "hour_range": "hour BETWEEN 0 AND 23",
        "day_range": "day BETWEEN 1 AND 31",
        "week_range": "week BETWEEN 0 AND 53",
        "month_range": "month BETWEEN 1 AND 12",
        "weekday_range": "weekday BETWEEN 0 AND 6",
    },
    partition_by=("year", "month"),
    sort_by=("start_time",),
)

SONGPLAYS = TableContract(
    "songplays",
    "songplay_id bigint, start_time timestamp_ntz, user_id int, level string, song_id string, "
    "artist_id string, session_id bigint, location string, user_agent string",
    not_null=("songplay_id", "start_time", "user_id", "level", "session_id"),
    primary_key=("songplay_id",),
    foreign_keys={
        "start_time": ("times", "start_time"),
        "user_id": ("users", "user_id"),
        "song_id": ("songs", "song_id"),
        "artist_id": ("artists", "artist_id"),
    },
    max_length={"level": 4, "location": 128, "user_agent": 256},
    partition_by=("year", "month"),
    cluster_by=("session_id",),
    sort_by=("start_time",),
)

# Facts with a digest as key: of what makes a row, or of session and time, which several rows share.
SONGPLAYS_BY_ROW = replace(
    SONGPLAYS, columns=SONGPLAYS.columns.replace("songplay_id bigint", "songplay_id string")
)
SONGPLAYS_BY_SESSION_TIME = replace(SONGPLAYS_BY_ROW, primary_key=())

# --- query tables ---

SONG_BY_ITEM_IN_SESSION = TableContract(
    "song_by_item_in_session",
    "session_id int, item_in_session int, artist string, song string, duration decimal(15,5)",
    primary_key=("session_id", "item_in_session"),
    cluster_by=("session_id",),
    sort_by=("session_id", "item_in_session"),
)

HISTORY_BY_SESSION = TableContract(
    "history_by_session",
    "user_id int, session_id int, item_in_session int, artist string, song string, "
    "first_name string, last_name string",
    primary_key=("user_id", "session_id", "item_in_session"),
    cluster_by=("user_id", "session_id"),
    sort_by=("user_id", "session_id", "item_in_session"),
)

USERS_BY_SONG = TableContract(
    "users_by_song",
    "song string, user_id int, first_name string, last_name string",
    primary_key=("song", "user_id"),
    cluster_by=("song",),
    sort_by=("song", "user_id"),
)

# --- arrivals, temperature and demographics, as they arrive ---

ARRIVALS = TableContract(
    "arrivals",
    "i94yr double, i94mon double, i94cit double, i94port string, arrdate double, "
    "i94mode double, i94addr string, depdate double, i94bir double, i94visa double, "
    "biryear double, gender string",
    not_null=(
        "i94yr", "i94mon", "i94cit", "i94port", "arrdate", "i94mode", "depdate", "i94addr",
        "gender", "i94bir", "i94visa",
    ),
)

CITY_TEMPERATURE_CSV = TableContract(
    "city_temperature",
    "dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string, "
    "Country string, Latitude string, Longitude string",
    not_null=("dt", "AverageTemperature", "City", "Country", "Latitude", "Longitude"),
)

CITY_DEMOGRAPHICS_CSV = TableContract(
    "city_demographics",
    "City string, State string, `Median Age` string, `Male Population` string, "
    "`Female Population` string, `Total Population` string, `Number of Veterans` string, "
    "`Foreign-born` string, `Average Household Size` string, `State Code` string, "
    "Race string, Count string",
    not_null=(
        "City", "State", "Median Age", "Male Population", "Female Population",
        "Total Population", "Number of Veterans", "Foreign-born", "Average Household Size",
        "State Code", "Race", "Count",
    ),
)

# --- arrivals star ---

DIM_IMMIGRATIONS = TableContract(
    "dim_immigrations",
    "year int, month int, origin_country_code int, port_code string, arr_date date, "
    "dep_date date, mode int, addr_state_abbr string, age int, reason int, birth_year int, "
    "gender string",
    partition_by=("year", "month"),
)

DIM_TEMPERATURES = TableContract(
    "dim_temperatures",
    "date date, avg_temperature double, city string, country string, latitude string, "
    "longitude string, port_code string",
    sort_by=("port_code", "date"),
)

DIM_CITY_DEMOS = TableContract(
    "dim_city_demos",
    "city string, state string, median_age double, male_population bigint, "
    "female_population bigint, total_population bigint, veteran_population bigint, "
    "foreign_born_population bigint, avg_household_size double, state_abbr string, "
    "race string, race_count bigint, port_code string",
    sort_by=("port_code",),
)

FACT_IMMIGRATIONS = TableContract(
    "fact_immigrations",
    "year int, month int, origin_country string, port_code string, arr_date date, "
    "dep_date date, mode int, addr_state_abbr string, age int, reason int, gender string, "
    "temperature_avg double, city_median_age double, city_total_population bigint",
    partition_by=("year", "month"),
)
