"""A state machine per document on a stream (`transformWithState`), keyed by file name.

Each file name keeps, across micro-batches, its manifest entry, the last observation time of each
of its URLs and its run of failed fetches. The initial state is the manifest of earlier runs.
A micro-batch is a run, as in `incremental.process_batch`: of several observations of a URL in it
the latest counts, and the URLs of one file name are handled in URL order, each against the state
the earlier ones left. The rules are those of `change.change_decision` and `outcome.outcome_status`:

* header error -> `error`; no entry -> fetch (`no_metadata`); announced length other than the
  entry's size -> fetch (`size_changed`); other URL -> `url_changed`; a date that is present and
  differs -> `last_modified_changed`; else `skipped_unchanged`;
* a fetch with a header error is `error`, over the size cap `too_large`, without body `error`
  ("no body"), with an invalid body `invalid_pdf`, else `success`, which replaces the entry.

States (per URL): unseen -> observed -> (stored | failing | skipped); a failing document gets an
event-time timer at `retry_after` past its failed observation; if the watermark passes it before a
success, a `retry_due` row is given out (with the count of failures), and the timer is set again.
A success clears the run of failures and its timer, and its row counts the failures before it, so
attempts that arrive over several micro-batches are folded: a file that fails in two batches and is
fetched in the third has a success row with two failures (three attempts). An observation of a URL that is not later than
the last one handled for it is late: it changes nothing and gives a row with status `late`.

What a file name keeps is one value, but for the times of its second and further URLs, which are a map: so
an observation reads and writes once, however many parts its state has.

Bodies never reach Python: length, checksum and validity are columns computed beforehand.
Every handled observation gives one output row; `seq` numbers a file name's rows, so the manifest is
the initial one with, per file name, the entry of its last `success` row (`manifest_after`).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from docflow.functions import content, urls
from docflow.operators import outcome

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RETRY_AFTER_MS = 6 * 3600 * 1000   # a failed document is due again after this much event time

# One value for all of a file name's state but the further URLs, so that the usual observation (one URL for
# a name) costs one read and one write: every call to the state store is a round trip between processes.
STATE = StructType([StructField(n, t) for n, t in (
    ("n", LongType()),                                                     # rows given out so far
    ("seen_url", StringType()), ("seen_ms", LongType()),                   # the first URL's last observation
    ("has_entry", BooleanType()), ("url", StringType()), ("size", LongType()), ("checksum", StringType()),
    ("last_modified", StringType()), ("downloaded_ms", LongType()), ("local_path", StringType()),
    ("failures", IntegerType()), ("error", StringType()), ("due_ms", LongType()))])  # failures: null without a run
OUT = StructType([StructField(n, t) for n, t in (
    ("filename", StringType()), ("seq", LongType()), ("url", StringType()), ("observed_ms", LongType()),
    ("decision", StringType()), ("reason", StringType()), ("status", StringType()), ("size", LongType()),
    ("checksum", StringType()), ("last_modified", StringType()), ("downloaded_ms", LongType()),
    ("local_path", StringType()), ("error", StringType()), ("failures", IntegerType()))])

OUT_ROW = Row(*OUT.names)


class DocumentMachine(StatefulProcessor):
    """The state machine of one file name; see the module's text."""

    def __init__(self, store: str, cap: int = content.SIZE_CAP, retry_after_ms: int = RETRY_AFTER_MS) -> None:
        self.store, self.cap, self.retry_after_ms = store.rstrip("/"), cap, retry_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.document = handle.getValueState("document", STATE)
        self.others = handle.getMapState("others", StructType([StructField("url", StringType())]),
                                         StructType([StructField("ms", LongType())]))

    def _load(self) -> None:
        """The file name's state, as fields that the handling changes and `_store` writes back."""
        have = self.document.get()
        self.n, self.seen_url, self.seen_ms = have[:3] if have else (0, None, None)
        self.entry = have[4:10] if have and have[3] else None
        self.failing = have[10:13] if have and have[10] is not None else None

    def _store(self) -> None:
        entry, failing = self.entry, self.failing
        self.document.update((self.n, self.seen_url, self.seen_ms, entry is not None, *(entry or (None,) * 6),
                              *(failing or (None,) * 3)))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState
        self.n, self.seen_url, self.seen_ms, self.failing = 0, None, None, None
        self.entry = (row.url, row.size, row.checksum, row.last_modified, row.downloaded_ms, row.local_path)
        self._store()

    def _row(self, filename, obs, decision, reason, status, entry=None, error=None, failures=0) -> Row:
        self.n += 1
        size, checksum, downloaded_ms, local_path = (
            (entry[1], entry[2], entry[4], entry[5]) if status == "success" else (None,) * 4)
        return OUT_ROW(filename, self.n, obs["url"], obs["observed_ms"], decision, reason, status, size, checksum,
                       obs["last_modified"], downloaded_ms, local_path, error, failures)

    def _is_late(self, url: str, at: int) -> bool:
        """Whether the URL was handled at that time or later; else notes the time."""
        if self.seen_ms is None or self.seen_url == url:
            last, self.seen_url = self.seen_ms, url
            if last is None or at > last:
                self.seen_ms = at
        else:
            last = (self.others.getValue((url,)) or (None,))[0] if self.others.containsKey((url,)) else None
            if last is None or at > last:
                self.others.updateValue((url,), (at,))
        return last is not None and at <= last

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        filename = key[0]
        latest: dict[str, dict] = {}
        for r in rows:
            obs = r.asDict()
            have = latest.get(obs["url"])
            if have is None or obs["observed_ms"] > have["observed_ms"]:
                latest[obs["url"]] = obs
        self._load()
        for url in sorted(latest):
            obs = latest[url]
            at = obs["observed_ms"]
            if self._is_late(url, at):
                yield self._row(filename, obs, "none", "late", "late")
            else:
                yield self._handle(filename, obs, at)
        self._store()

    def _handle(self, filename: str, obs: dict, at: int) -> Row:
        entry = self.entry
        head_error = obs["head_error"]
        length = obs["content_length"]
        if head_error is not None:
            decision, reason = "error", "head_error"
        elif entry is None:
            decision, reason = "fetch", "no_metadata"
        elif entry[1] != length:
            decision, reason = "fetch", "size_changed"
        elif entry[0] != obs["url"]:
            decision, reason = "fetch", "url_changed"
        elif obs["last_modified"] not in (None, "") and obs["last_modified"] != entry[3]:
            decision, reason = "fetch", "last_modified_changed"
        else:
            return self._row(filename, obs, "skip", "unchanged", "skipped_unchanged")
        if head_error is not None:
            status, error = "error", head_error
        elif length > self.cap:
            status, error = "too_large", None
        elif obs["body_size"] is None:
            status, error = "error", "no body"
        elif not obs["is_valid"]:
            status, error = "invalid_pdf", None
        else:
            status, error = "success", None
        if status == "success":
            self.entry = (obs["url"], obs["body_size"], obs["checksum"], obs["last_modified"], at,
                          f"{self.store}/{filename}")
            before = self._clear_failures()
            return self._row(filename, obs, decision, reason, status, self.entry, failures=before)
        failures = 0
        if status == "error":
            failures = (self.failing[0] if self.failing else 0) + 1
            if self.failing:
                self.handle.deleteTimer(self.failing[2])
            due = at + self.retry_after_ms
            self.failing = (failures, error, due)
            self.handle.registerTimer(due)
        return self._row(filename, obs, decision, reason, status, error=error, failures=failures)

    def _clear_failures(self) -> int:
        """Ends a run of failures; gives how many there were."""
        if not self.failing:
            return 0
        failures, _, due = self.failing
        self.handle.deleteTimer(due)
        self.failing = None
        return failures

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._load()
        if not self.failing:
            return
        failures, error, due = self.failing
        self.n += 1
        again = due + self.retry_after_ms
        self.failing = (failures, error, again)
        self._store()
        self.handle.registerTimer(again)
        yield OUT_ROW(key[0], self.n, self.entry[0] if self.entry else None, due, "fetch", "retry", "retry_due", None,
                      None, None, None, None, error, failures)

    def close(self) -> None:
        pass


def observations(stream: DataFrame, validator=None) -> DataFrame:
    """Observations reduced to what the machine needs; the body becomes length, checksum, validity."""
    length = F.coalesce("content_length", F.lit("0")).try_cast("bigint")
    valid = content.pdf_check(F.col("content")) if validator is None else validator
    has_body = F.col("content").isNotNull()
    return stream.select(
        urls.document_filename(F.col("url")).alias("filename"),
        "url",
        length.alias("content_length"),
        "last_modified",
        F.coalesce("error", F.when(length.isNull(), F.concat(F.lit("invalid content-length: "), "content_length")))
        .alias("head_error"),
        F.when(has_body, F.octet_length("content").cast("bigint")).alias("body_size"),
        F.when(has_body, content.content_checksum(F.col("content"))).alias("checksum"),
        F.when(has_body, F.coalesce(valid, F.lit(False))).alias("is_valid"),
        "observed_at",
        F.unix_millis("observed_at").alias("observed_ms"),
    )


def document_states(stream: DataFrame, manifest: DataFrame, store: str, delay: str = "1 hour",
                    cap: int = content.SIZE_CAP, retry_after_ms: int = RETRY_AFTER_MS) -> DataFrame:
    """Rows of the machines of all file names (schema `OUT`), in append mode and event time.

    A manifest without entries is not handed over as initial state: Spark would send every file name of
    the first micro-batch to Python in a batch of its own, for nothing.

    The state store must be RocksDB, which `transformWithState` requires; a session without a provider
    setting gets it (the setting is read when the query starts).
    """
    spark = stream.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    initial = manifest.select("filename", "url", "size", "checksum", "last_modified",
                              F.unix_millis("downloaded_at").alias("downloaded_ms"), "local_path").groupBy("filename")
    rows = (
        observations(stream).withWatermark("observed_at", delay).groupBy("filename")
        .transformWithState(DocumentMachine(store, cap, retry_after_ms), OUT, "Append", "EventTime",
                            initialState=None if manifest.isEmpty() else initial)
    )
    times = {"observed_at": F.timestamp_millis("observed_ms"), "downloaded_at": F.timestamp_millis("downloaded_ms")}
    return rows.withColumns(times).drop("observed_ms", "downloaded_ms")


def manifest_after(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """The manifest once the machines' rows are applied: each file name's last success replaces it."""
    stored = rows.filter(F.col("status") == "success")
    last = stored.groupBy("filename").agg(F.max_by(F.struct(*[c for c in stored.columns if c != "filename"]), "seq")
                                          .alias("r"))
    new = last.select("filename", "r.url", "r.size", "r.checksum", "r.last_modified", "r.downloaded_at", "r.local_path")
    return outcome.upsert_manifest(manifest.select(*new.columns), new)
