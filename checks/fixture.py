"""Log data derived from the given tables, for Spark and for the SQL checks.

The given tables hold no syslog text, so every row of ``events`` is written as one syslog line with
its structured companion, and every row of ``documents`` as one log entry. The first three
statements are one text for both engines.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.operators.encoders import HashingEncoder
from timberline.operators.rollups import distinct_messages, short_name
from timberline.plans.prepare import log_entries
from timberline.schemas import LOG_ENTRIES
from timberline.session import released_folders, shared_folder
from timberline.sinks.tables import write_logs
from timberline.sources.tables import with_row_id

CONTENT = """
SELECT *, CASE event_id % 10
  WHEN 0 THEN 'Failed password for invalid user u' || CAST(user_id AS STRING) || ' from ' || ip || ' port ' || CAST(30000 + event_id % 1000 AS STRING) || ' ssh2'
  WHEN 1 THEN 'Failed password for u' || CAST(user_id AS STRING) || ' from ' || ip || ' port 22 ssh2'
  WHEN 2 THEN 'Invalid  user u' || CAST(user_id AS STRING) || ' from ' || ip
  WHEN 3 THEN 'Connection closed by ' || ip || ' [preauth]'
  WHEN 4 THEN 'Received disconnect from ' || ip || ': 11: Bye Bye [preauth]'
  WHEN 5 THEN 'reverse mapping checking getaddrinfo for host' || CAST(user_id % 8 AS STRING) || ' failed - POSSIBLE BREAK-IN ATTEMPT!'
  WHEN 6 THEN 'Disconnecting: Too many authentication failures for root [preauth]'
  WHEN 7 THEN 'pam_unix(sshd:auth): authentication failure; rhost=' || ip
  WHEN 8 THEN 'Accepted password for u' || CAST(user_id AS STRING) || ' from ' || ip || ' port 22 ssh2'
  ELSE 'Server listening on 0.0.0.0 port 22.' END AS content
FROM (SELECT *, '10.0.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING) AS ip FROM {events}) e
"""

# Lines of tiny value are garbled: no prefix can be parsed from them.
RAW = """
SELECT event_id + 1 AS line_id,
  CASE WHEN value < 0.5 THEN 'malformed line ' || CAST(event_id AS STRING)
  ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', (month(ts) - 1) * 3 + 1, 3) || ' ' || CAST(day(ts) AS STRING)
    || ' ' || lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')
    || ':' || lpad(CAST(CAST(second(ts) AS INT) AS STRING), 2, '0')
    || ' host' || CAST(user_id % 8 AS STRING) || ' sshd[' || CAST(20000 + event_id AS STRING) || ']: ' || content END AS raw_line
FROM {log_content}
"""

# The structured file is incomplete: it lacks the errors of high value.
STRUCTURED = """
SELECT event_id + 1 AS line_id, content AS raw_message, 'E' || CAST(event_id % 10 AS STRING) AS event_id,
  CASE event_id % 10
    WHEN 0 THEN 'Failed password for invalid user <*> from <*> port <*> ssh2'
    WHEN 1 THEN 'Failed password for <*> from <*> port <*> ssh2'
    WHEN 2 THEN 'Invalid  user <*> from <*>'
    WHEN 3 THEN 'Connection closed by <*> [preauth]'
    WHEN 4 THEN 'Received disconnect from <*>: 11: Bye Bye [preauth]'
    WHEN 5 THEN 'reverse mapping checking getaddrinfo for <*> failed - POSSIBLE BREAK-IN ATTEMPT!'
    WHEN 6 THEN 'Disconnecting: Too many authentication failures for root [preauth]'
    WHEN 7 THEN 'pam_unix(sshd:auth): authentication failure; rhost=<*>'
    WHEN 8 THEN 'Accepted password for <*> from <*> port <*> ssh2'
    ELSE 'Server listening on <*> port <*>.' END AS event_template
FROM {log_content} WHERE event_type <> 'error' OR value < 100
"""

TEMPLATES = """
SELECT event_id, event_template, CAST(count(*) AS INT) AS occurrences
FROM {log_structured} GROUP BY event_id, event_template
"""

# Requests for the search checks: every template's text asks for lines of its kind. Every second
# event also names a level, every third its own number of results.
REQUESTS = """
SELECT CAST(substr(event_id, 2, 1) AS BIGINT) AS query_id, event_template AS text,
  CASE event_id WHEN 'E0' THEN 'ERROR' WHEN 'E2' THEN 'INFO' WHEN 'E4' THEN 'WARNING' WHEN 'E6' THEN 'CRITICAL' WHEN 'E8' THEN 'INFO' ELSE 'ALL' END AS level,
  CASE event_id WHEN 'E0' THEN 5 WHEN 'E3' THEN 30 WHEN 'E6' THEN 100 WHEN 'E9' THEN 1 END AS top_k
FROM {event_templates}
"""

SEARCH_DIMENSION = 64

# Derived tables that were written ahead, by folder of the given tables and by name.
_ahead: dict[tuple[str, str], str] = {}


@contextmanager
def stored_tables(spark: SparkSession, folder: str) -> Iterator[None]:
    """Writes the derived tables ahead; queries on this folder read them until the end."""
    with released_folders(spark):
        data = LogData(spark, folder)
        for name in ("raw", "structured", "logs", "document_vectors"):
            path = shared_folder(spark, f"ahead-{name}")
            table = getattr(data, name)()
            if name == "logs":
                write_logs(table.drop("id"), path)
            else:
                table.write.parquet(path)
            _ahead[folder, name] = path
        vectors = shared_folder(spark, "ahead-vectors")
        data.vectors().write.parquet(vectors)
        _ahead[folder, "vectors"] = vectors
        try:
            yield
        finally:
            for key in [key for key in _ahead if key[0] == folder]:
                del _ahead[key]


class LogData:
    """The derived tables as DataFrames; nothing is computed until a query uses one."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._stored: DataFrame | None = None

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def content(self) -> DataFrame:
        return self.spark.sql(CONTENT, events=self.given("events"))

    def _written(self, name: str) -> DataFrame | None:
        path = _ahead.get((self.folder, name))
        return None if path is None else self.spark.read.parquet(path)

    def raw(self) -> DataFrame:
        written = self._written("raw")
        return written if written is not None else self.spark.sql(RAW, log_content=self.content())

    def structured(self) -> DataFrame:
        written = self._written("structured")
        return written if written is not None else self.spark.sql(STRUCTURED, log_content=self.content())

    def templates(self) -> DataFrame:
        return self.spark.sql(TEMPLATES, log_structured=self.structured())

    def requests(self) -> DataFrame:
        return self.spark.sql(REQUESTS, event_templates=self.templates())

    def logs(self) -> DataFrame:
        return with_row_id(log_entries(self.raw(), self.structured()))

    def stored_logs(self) -> DataFrame:
        """The log table written as it is stored, one folder per level, for queries that read it often."""
        if self._stored is None:
            path = _ahead.get((self.folder, "logs"))
            if path is None:
                path = shared_folder(self.spark, "log-table")
                write_logs(self.logs().drop("id"), path)
            self._stored = with_row_id(self.spark.read.schema(LOG_ENTRIES).parquet(path))
        return self._stored

    def vectors(self, dimension: int = SEARCH_DIMENSION) -> DataFrame:
        """Hashed vectors of all distinct log messages."""
        written = self._written("vectors") if dimension == SEARCH_DIMENSION else None
        if written is not None:
            return written
        return HashingEncoder(dimension).encode(distinct_messages(self.stored_logs()), "normalized_message")

    def document_logs(self) -> DataFrame:
        """Documents as log entries: source is the event, language the level; German has no time."""
        start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        return self.given("documents").select(
            F.col("doc_id").alias("id"),
            F.col("doc_id").alias("line_id"),
            F.when(
                F.col("lang") != "de", start + F.make_dt_interval(secs=F.col("n_chars").cast("decimal(18,6)"))
            ).alias("log_timestamp"),
            F.col("lang").alias("level"),
            F.col("source").alias("event_id"),
            F.col("text").alias("raw_message"),
            F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))).alias("normalized_message"),
            F.lit(None).cast("string").alias("event_template"),
        )

    def document_vectors(self) -> DataFrame:
        """A given vector for every distinct document message."""
        written = self._written("document_vectors")
        if written is not None:
            return written
        given = self.given("embeddings")
        size = given.count()
        # Messages are whole documents: they are moved once, and matched by short names, NULL by one of its own.
        name = F.coalesce(short_name("normalized_message"), F.lit("#" * 66)).alias("_name")
        logs = self.document_logs().select("id", "normalized_message", name)
        vectors = (
            logs.groupBy("_name")
            .agg(F.min("id").alias("first_id"))
            .withColumn("vec_id", F.col("first_id") % size)
            .join(given, "vec_id")
            .select("_name", "embedding", "vec_id", "label")
        )
        messages = logs.groupBy("_name").agg(F.first("normalized_message").alias("normalized_message"))
        return messages.join(vectors, "_name").drop("_name")

    def vectors_without_label(self, label: int) -> DataFrame:
        """The vectors of document messages but those of one label, as if that had not been loaded yet."""
        return self.document_vectors().where(F.col("label") != label)

    def label_vectors(self) -> DataFrame:
        """The first vector of every label, as query vectors."""
        return (
            self.given("embeddings")
            .groupBy("label")
            .agg(F.min_by("embedding", "vec_id").alias("embedding"))
            .select(F.col("label").cast("bigint").alias("query_id"), "embedding")
        )


def _sql(statement: str) -> str:
    for name in ("events", "log_content", "log_structured", "event_templates"):
        statement = statement.replace("{" + name + "}", name)
    return statement.strip()


# Fixed values, written out here so that the SQL does not share them with what it checks.
_PREFIX_SQL = r"^([A-Z][a-z]{2})\s+(\d{1,2})\s+(\d{2}:\d{2}:\d{2})\s+(\S+)\s+([^\[]+)\[(\d+)\]:\s+(.*)$"
_LEVEL_SQL = """CASE WHEN contains(t, 'possible break-in attempt') OR contains(t, 'too many authentication failures') THEN 'CRITICAL'
  WHEN contains(t, 'failed password') OR contains(t, 'authentication failure') OR contains(t, 'fatal') OR contains(t, 'error')
    OR contains(t, 'invalid user') OR contains(t, 'user unknown') THEN 'ERROR'
  WHEN contains(t, 'disconnect') OR contains(t, 'closed by') OR contains(t, 'preauth') OR contains(t, 'reverse mapping') THEN 'WARNING'
  ELSE 'INFO' END"""


def _level_sql(text: str) -> str:
    return _LEVEL_SQL.replace("(t,", f"({text},")


def _field(number: int) -> str:
    return f"nullif(regexp_extract(raw_line, '{_PREFIX_SQL}', {number}), '')"


LOG_CTES = f"""log_content AS ({_sql(CONTENT)}),
log_raw AS ({_sql(RAW)}),
log_structured AS ({_sql(STRUCTURED)}),
event_templates AS ({_sql(TEMPLATES)}),
requests AS ({_sql(REQUESTS)}),
fields AS (
  SELECT line_id, raw_line, {_field(1)} AS month, CAST({_field(2)} AS INT) AS day, {_field(3)} AS time_text,
    {_field(4)} AS host, trim({_field(5)}) AS service, CAST({_field(6)} AS INT) AS process_id, {_field(7)} AS content
  FROM log_raw),
parsed AS (
  SELECT *, try_strptime('2024 ' || month || ' ' || day || ' ' || time_text, '%Y %b %-d %H:%M:%S') AS log_timestamp
  FROM fields),
joined AS (
  SELECT p.line_id, 'OpenSSH' AS source, log_timestamp, month, day, time_text, host, service, process_id, s.event_id,
    coalesce(s.raw_message, p.content, p.raw_line) AS raw_message, s.event_template
  FROM parsed p LEFT JOIN log_structured s ON s.line_id = p.line_id),
logs AS (
  SELECT *, line_id AS id, {_level_sql('lower(raw_message)')} AS level,
    lower(regexp_replace(coalesce(event_template, raw_message), '\\s+', ' ', 'g')) AS normalized_message
  FROM joined)"""

LOG_COLUMN_SQL = (
    "line_id, source, log_timestamp, month, day, time_text, host, service, process_id, level, event_id, "
    "raw_message, normalized_message, event_template"
)

DOCUMENT_CTES = r"""document_logs AS (
  SELECT doc_id AS id, doc_id AS line_id,
    CASE WHEN lang <> 'de' THEN TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n_chars) END AS log_timestamp,
    lang AS level, source AS event_id, text AS raw_message,
    lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS normalized_message
  FROM documents),
document_vectors AS (
  SELECT m.normalized_message, e.embedding, e.vec_id, e.label
  FROM (SELECT normalized_message, min(id) AS first_id FROM document_logs GROUP BY ALL) m
  JOIN embeddings e ON e.vec_id = m.first_id % (SELECT count(*) FROM embeddings)),
label_vectors AS (
  SELECT CAST(label AS BIGINT) AS query_id, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label)"""


def dot_sql(left: str, right: str) -> str:
    return (
        f"list_sum(list_transform(list_zip({left}, {right}), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"
    )


def cosine_sql(left: str, right: str) -> str:
    lengths = f"(sqrt({dot_sql(left, left)}) * sqrt({dot_sql(right, right)}))"
    return f"CASE WHEN {lengths} = 0 THEN 0.0 ELSE {dot_sql(left, right)} / {lengths} END"


def rounded_sql(value: str, decimals: int) -> str:
    """The nearest decimal to the exact double, as the library rounds: via its exact digits."""
    scale = 10**decimals
    scaled, high = f"(({value}) * {scale}e0)", f"(({value}) * 134217729e0 - (({value}) * 134217729e0 - ({value})))"
    rest = f"(({high} * {scale}e0 - {scaled}) + (({value}) - {high}) * {scale}e0)"
    part = f"({scaled} - floor({scaled}))"
    up = f"{part} > 0.5e0 OR ({part} = 0.5e0 AND ({rest} > 0 OR ({rest} = 0 AND floor({scaled}) % 2 = 1)))"
    return f"((floor({scaled}) + CASE WHEN {up} THEN 1 ELSE 0 END) / {scale}e0)"


def mean_sql(value: str) -> str:
    """Mean over exact decimals; texts carry the digits both ways without a rounding of their own."""
    total = f"sum(CAST(CAST({value} AS VARCHAR) AS DECIMAL(20, 18)))"
    return f"CAST(CAST({total} AS VARCHAR) AS DOUBLE) / count({value})"


def hashed_ctes(name: str, source: str, key: str, text: str, dimension: int) -> str:
    """CTEs that end in ``name(<key>, embedding)``: hashed word vectors of ``text`` as full lists."""
    return f"""{name}_words AS (
  SELECT {key}, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) AS code
  FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS word FROM {source})),
{name}_sums AS (
  SELECT {key}, (code >> 4) % {dimension} AS cell, CAST(sum(1 - 2 * (code & 1)) AS DOUBLE) AS total
  FROM {name}_words GROUP BY ALL),
{name}_lengths AS (SELECT {key}, sqrt(sum(total * total)) AS length FROM {name}_sums GROUP BY ALL),
{name}_grid AS (SELECT {key}, unnest(range({dimension})) AS cell FROM (SELECT DISTINCT {key} FROM {source})),
{name} AS (
  SELECT g.{key}, list(CAST(coalesce(CASE WHEN length = 0 THEN 0 ELSE total / length END, 0) AS FLOAT) ORDER BY g.cell) AS embedding
  FROM {name}_grid g LEFT JOIN {name}_sums s ON s.{key} = g.{key} AND s.cell = g.cell
    LEFT JOIN {name}_lengths l ON l.{key} = g.{key}
  GROUP BY g.{key})"""
