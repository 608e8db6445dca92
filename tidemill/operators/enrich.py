"""Classification by an external model and parent lookup in a dimension."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.fixed_values import INDUSTRY_FIELDS, REPLY_SUCCESS
from tidemill.functions.columns import free_prefix
from tidemill.functions.jsons import (
    in_whitelist,
    industry_keys,
    join_ids,
    json_strings,
    reply_ok,
)
from tidemill.operators.calls import TIMEOUT, Inputs, Outcome, timed_calls, timed_stream
from tidemill.operators.cells import project_cells
from tidemill.session import bounded_batches, shared_dir

# A scorer takes a list of texts and returns one reply text (or None) each.
Scorer = Callable[[list[str]], list[str | None]]
#: Tasks per core of calls with a deadline.  What they wait for follows their rows, so all get the same number of rows.
WAITING_TASKS = 3


def classify(
    posts: DataFrame,
    make_scorer: Callable[[], Scorer],
    text: str = "post_content",
    max_attempts: int = 3,
    wait_seconds: float = 0.0,
    concurrency: int | None = None,
    deadline_seconds: float | None = None,
    in_flight: int = 10,
    call_texts: int = 100,
) -> DataFrame:
    """Add ``sub_industry_id`` (sorted ids), ``attempts``, ``classify_status``
    (``ok``, ``failed``, ``timeout``, or ``skipped`` for empty texts) and
    ``classify_error``, what the last attempt of a failed text met.

    ``make_scorer`` is called once per task, so a client is opened once and
    used for all of its batches.  Only the text crosses to Python, in Arrow
    batches of bounded bytes (a batch is one call); other columns stay in the
    JVM.  Texts without a successful reply
    are sent again, at most ``max_attempts`` times, and then reported as
    failed.  ``concurrency`` bounds the number of tasks calling the service.

    With ``deadline_seconds`` a batch is sent in calls of ``call_texts`` texts,
    at most ``in_flight`` of them at once in a task (the scorer must bear that),
    and a call that is not done in time counts as a failed attempt; the next
    batches do not wait for it.  The posts are then dealt out evenly over
    WAITING_TASKS tasks per core, unless ``concurrency`` is given.  An error of
    the service is a failed attempt too; ``TypeError``, ``AttributeError`` and
    ``NameError`` are errors of the program and fail the task.
    """
    p = free_prefix(posts.columns)

    @F.pandas_udf("reply string, attempts int, error string")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        try:
            if deadline_seconds is not None:
                given = (_Texts(texts, max_attempts, call_texts) for texts in batches)
                for found in timed_stream(scorer, given, deadline_seconds, in_flight, wait_seconds):
                    yield found.frame()
                return
            for texts in batches:
                found = _Texts(texts, max_attempts, None)
                while calls := found.calls():
                    found.answered(timed_calls(scorer, calls))
                    if found.pending and wait_seconds:
                        time.sleep(wait_seconds)
                yield found.frame()
        finally:
            close = getattr(scorer, "close", None)
            if close:
                close()

    bounded_batches(posts.sparkSession)
    tasks = concurrency
    if deadline_seconds is not None and not concurrency:
        tasks = WAITING_TASKS * posts.sparkSession.sparkContext.defaultParallelism
    source = posts.repartition(tasks) if tasks else posts
    # non-deterministic: the optimizer may neither repeat nor move the call
    scored = source.withColumn(f"{p}s", score.asNondeterministic()(F.col(text)))
    # the reply is checked in a projection of its own, once
    checked = scored.withColumn(f"{p}ok", reply_ok(f"{p}s.reply"))
    attempts, error, ok = F.col(f"{p}s.attempts"), F.col(f"{p}s.error"), F.col(f"{p}ok")
    status = F.when(attempts == 0, "skipped").when(ok, "ok").when(error == TIMEOUT, TIMEOUT).otherwise("failed")
    added = {
        "sub_industry_id": F.when(ok, industry_keys(f"{p}s.reply")),
        "attempts": attempts,
        "classify_status": status,
        "classify_error": error,
    }
    return checked.select(*[c for c in posts.columns if c not in added], *[c.alias(n) for n, c in added.items()])


def _succeeded(reply: str | None) -> bool:
    try:
        return json.loads(reply)["msg"] == REPLY_SUCCESS
    except (TypeError, ValueError, KeyError):
        return False


class _Texts(Inputs):
    """The texts of one batch with what they met.  A text is let go once it is answered."""

    def __init__(self, texts: pd.Series, max_attempts: int, call_texts: int | None):
        self.texts, self.size, self.call_texts = texts.tolist(), len(texts), call_texts
        self.replies: list[str | None] = [None] * self.size
        self.errors: list[str | None] = [None] * self.size
        self.attempts = [0] * self.size
        self.pending = [i for i, t in enumerate(self.texts) if t]
        self.left, self.parts = max_attempts, []

    def calls(self) -> list[list[str]]:
        self.left -= 1
        step = self.call_texts or max(len(self.pending), 1)
        self.parts = [self.pending[k : k + step] for k in range(0, len(self.pending), step)] if self.left >= 0 else []
        return [[self.texts[i] for i in part] for part in self.parts]

    def answered(self, outcomes: list[Outcome]) -> None:
        for part, outcome in zip(self.parts, outcomes, strict=True):
            answers = [None] * len(part) if outcome.error else outcome.value
            for i, answer in zip(part, answers, strict=True):
                self.replies[i], self.errors[i] = answer, outcome.error
                self.attempts[i] += 1
                if self.left < 1 or _succeeded(answer):
                    self.texts[i] = None
        self.pending = [i for i in self.pending if self.texts[i] is not None]

    def frame(self) -> pd.DataFrame:
        replied, failed = pd.Series(self.replies, dtype="object"), pd.Series(self.errors, dtype="object")
        return pd.DataFrame({"reply": replied, "attempts": self.attempts, "error": failed})


class Replies:
    """Replies of a model by the digest of the text, in a folder that later runs use again.

    Only successful replies are kept.  A run adds a folder of its own under a name that is new each time, so a run that
    failed or ran twice leaves repeated rows at most, and these say the same.
    """

    SCHEMA = "digest binary, sub_industry_id array<string>"

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def read(self, spark) -> DataFrame:
        """``digest, sub_industry_id``, one row per digest."""
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            return spark.createDataFrame([], self.SCHEMA)
        kept = spark.read.schema(self.SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)
        return kept.groupBy("digest").agg(F.min("sub_industry_id").alias("sub_industry_id"))

    def add(self, replies: DataFrame) -> None:
        replies.select("digest", "sub_industry_id").write.parquet(f"{self.path}/{uuid.uuid4().hex}")


def classify_distinct(
    posts: DataFrame, make_scorer: Callable[[], Scorer], replies: Replies | None = None, text: str = "post_content", **options
) -> DataFrame:
    """``classify`` with one call for each distinct text, and none for texts that ``replies`` holds.

    Equal texts shrink to one row per task before they are shuffled, by their SHA-256.  Posts whose text was not sent here
    have 0 ``attempts`` and the status ``ok``; the others share what their text met.  The posts meet the replies by digest,
    texts included: a shuffle against a call per copy.
    """
    p = free_prefix(posts.columns)
    digest, spark = f"{p}digest", posts.sparkSession
    keyed = posts.withColumn(digest, F.unhex(F.sha2(F.col(text), 256)))
    sent = keyed.where(F.length(text) > 0).groupBy(F.col(digest).alias("digest")).agg(F.any_value(text).alias("post_content"))
    known = None
    if replies is not None:
        known = staged(replies.read(spark))
        sent = sent.join(known, "digest", "left_anti")
    made = staged(classify(sent, make_scorer, **options).drop("post_content"))
    if known is not None:
        replies.add(made.where("classify_status = 'ok'"))
        old = {"attempts": F.lit(0), "classify_status": F.lit("ok"), "classify_error": F.lit(None).cast("string")}
        made = made.unionByName(known.withColumns(old))
    reply = F.struct("sub_industry_id", "attempts", "classify_status", "classify_error").alias(f"{p}r")
    found = keyed.join(made.select(F.col("digest").alias(digest), reply), digest, "left")
    added = {
        "sub_industry_id": F.col(f"{p}r.sub_industry_id"),
        "attempts": F.coalesce(f"{p}r.attempts", F.lit(0)),
        "classify_status": F.coalesce(f"{p}r.classify_status", F.lit("skipped")),
        "classify_error": F.col(f"{p}r.classify_error"),
    }
    return found.select(*[c for c in posts.columns if c not in added], *[c.alias(n) for n, c in added.items()])


def keep_whitelisted(posts: DataFrame, ids: str = "sub_industry_id") -> DataFrame:
    """Posts with an id among the industries of interest."""
    return posts.filter(in_whitelist(ids))


# -- parent lookup -----------------------------------------------------------


def industry_dimension(cells: DataFrame) -> DataFrame:
    """The dimension ``(id, parent_id)`` from its cell table."""
    parents = project_cells(cells, ["parent_id"], empty_rows=False)
    return parents.select(F.col("rowkey").alias("id"), "parent_id")


MAX_INLINE_ENTRIES = 100_000
MAX_INLINE_BYTES = 16 << 20


def measure(dimension: DataFrame) -> tuple[int, int]:
    """Rows and text bytes of a two-column dimension ``(id, parent_id)``."""
    size = F.octet_length("id") + F.octet_length("parent_id")
    row = dimension.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return row[0], row[1]


def lookup_parents(
    posts: DataFrame,
    dimension: DataFrame,
    key: list[str] | None = None,
    ids: str = "sub_industry_id",
    strategy: str = "auto",
    stage: bool = False,
) -> DataFrame:
    """Replace the id array by a sorted comma string and add ``parent_id``
    (the distinct parents of all ids, sorted, comma-joined) and
    ``enrich_status``.  Every post is kept, and each is looked up for itself;
    ids without a match add nothing.

    ``dimension`` has columns ``id, parent_id``.  ``inline`` needs it below the
    checked bounds and shuffles nothing.  ``join`` works for any size: posts are
    written with a row number and that identifies them.  ``auto`` measures; a
    dimension beyond the bounds is first reduced to the ids that occur, which
    mostly brings it below them.

    ``key`` and ``stage`` are no longer needed: rows with equal or NULL keys are
    posts of their own, and ``join`` always reads written posts, so that a model
    which gave their ids is called once.
    """
    if strategy not in ("auto", "inline", "join"):
        raise ValueError(f"unknown strategy {strategy!r}")
    entries = dimension.select(
        F.col("id").cast("string"), F.col("parent_id").cast("string")
    ).filter(F.col("id").isNotNull() & F.col("parent_id").isNotNull())
    columns, rows, p = posts.columns, 1, free_prefix(posts.columns)
    if strategy != "join":
        rows, size = measure(entries)
        fits = rows <= MAX_INLINE_ENTRIES and size <= MAX_INLINE_BYTES
        if strategy == "inline" and not fits:
            raise ValueError(f"dimension of {rows} rows, {size} bytes is too large to inline")
        strategy = "inline" if fits else "reduce"
    if strategy != "inline":
        posts = staged(posts.withColumn(f"{p}row", F.monotonically_increasing_id()))
    if strategy == "reduce":
        occurring = posts.select(F.explode(ids).alias("id")).distinct()
        entries = staged(entries.join(occurring, "id", "left_semi"))
        rows, size = measure(entries)
        fits = rows <= MAX_INLINE_ENTRIES and size <= MAX_INLINE_BYTES
        strategy = "inline" if fits else "join"
    if strategy == "inline":
        found = _inline_parents(posts, entries, ids, max(rows, 1), p)
    else:
        found = _joined_parents(posts, entries, ids, p)

    status = (
        F.when((F.col(f"{p}n_ids") == 0) | (F.size(f"{p}parents") > 0), "ok").otherwise("unmatched")
    )
    if "classify_status" in columns:
        status = F.when(F.col("classify_status").isin("failed", TIMEOUT), "failed").otherwise(status)
    kept = [c for c in columns if c not in (ids, "parent_id", "enrich_status")]
    return found.select(
        *kept,
        F.col(f"{p}ids").alias(ids),
        join_ids(f"{p}parents").alias("parent_id"),
        status.alias("enrich_status"),
    )


def _count(ids: Column | str) -> Column:
    """Entries of an array, 0 for NULL whatever the ANSI setting."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.when(ids.isNull(), 0).otherwise(F.size(ids))


def staged(df: DataFrame) -> DataFrame:
    """The frame as a written table: its lineage ends here."""
    path = shared_dir(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _slot(c: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(slots)).cast("int")


def _inline_parents(posts: DataFrame, entries: DataFrame, ids: str, slots: int, p: str) -> DataFrame:
    """The dimension as one array of about one entry per slot, found by the
    hash of the id: constant work per id, where a map value is searched from
    the front.  It reaches the rows as a scalar subquery, so there is no join.

    Everything derived from the ids is one expression that reads the ids once
    and the table once.  Only then does the optimizer merge the projections;
    otherwise the table would be copied into every row.
    """
    spark = entries.sparkSession
    filled = entries.groupBy(_slot(F.col("id"), slots).alias("slot")).agg(
        F.collect_list(F.struct("id", "parent_id")).alias("entries")
    )
    table = (
        spark.range(slots)
        .select(F.col("id").cast("int").alias("slot"))
        .join(filled, "slot", "left")
        .agg(F.array_sort(F.collect_list(F.struct("slot", "entries"))).alias("slots"))
    )

    def matches(one_id: Column) -> Column:
        slot = F.col(f"{p}table")[_slot(one_id, slots)]["entries"]
        hits = F.filter(slot, lambda e: e["id"] == one_id)
        return F.transform(F.coalesce(hits, F.array()), lambda e: e["parent_id"])

    def derive(given: Column) -> Column:
        known = F.array_compact(F.coalesce(given, F.array()))
        return F.struct(
            join_ids(given).alias("ids"),
            _count(given).alias("n_ids"),
            F.array_distinct(F.flatten(F.transform(known, matches))).alias("parents"),
        )

    kept = [c for c in posts.columns if c != ids]
    return (
        posts.withColumn(f"{p}table", table.scalar())
        .select(*kept, F.transform(F.array(ids), derive)[0].alias(f"{p}d"))
        .select(
            *kept,
            F.col(f"{p}d.ids").alias(f"{p}ids"),
            F.col(f"{p}d.n_ids").alias(f"{p}n_ids"),
            F.col(f"{p}d.parents").alias(f"{p}parents"),
        )
    )


def _joined_parents(posts: DataFrame, entries: DataFrame, ids: str, p: str) -> DataFrame:
    """By joins, for a dimension of any size.  ``(row, id)`` pairs meet the
    dimension without the posts' other columns; an id in most posts is a skewed
    join, which Spark splits.  The parents of a post then meet it by its row
    number."""
    pairs = posts.select(f"{p}row", F.explode(F.array_distinct(ids)).alias("id"))
    parents = pairs.join(entries, "id").groupBy(f"{p}row").agg(F.collect_set("parent_id").alias(f"{p}parents"))
    return (
        posts.withColumn(f"{p}ids", join_ids(ids))
        .withColumn(f"{p}n_ids", _count(ids))
        .join(parents, f"{p}row", "left")
        .withColumn(f"{p}parents", F.coalesce(f"{p}parents", F.array()))
    )


def lookup_from_json(
    messages: DataFrame, dimension: DataFrame, key: list[str], value: str = "value", **options
) -> DataFrame:
    """Earlier variant: ids come from three fixed JSON fields, and only
    ``parent_id`` is returned, as JSON text beside the key."""
    ids = messages.select(*key, json_strings(value, INDUSTRY_FIELDS).alias("sub_industry_id"))
    found = lookup_parents(ids, dimension, **options)
    return found.select(*key, F.to_json(F.struct("parent_id")).alias("value"))


def split_failures(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Enriched rows and the dead-letter rows whose enrichment failed."""
    failed = F.col("enrich_status") == "failed"
    return enriched.filter(~failed), enriched.filter(failed)
