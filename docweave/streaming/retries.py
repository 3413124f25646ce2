"""Pages that fail come back: a state machine over a stream of outcomes, with a dead-letter output.

A stream tells what became of every request for a page: (key, address, attempt, status, body, at). ``machine`` keeps for each key
which request is open and answers with rows of three kinds:

* ``request``: try that address, for the n-th time, not before ``due``;
* ``done``: the page's text;
* ``dead``: neither address gave anything, and why.

The first address is a page's own, the second that of its plain text. A status of 200 with a body ends a key. 404, or an empty
body, moves on to the second address, or ends it as ``missing``. Anything else (429, an error, no status) is tried again at
the same address after a pause that doubles each time, ``most`` times in all; then the second address is tried, then the
key is dead as ``exhausted``. A request without an outcome ``patience`` seconds after it was due counts as one without a status:
an event-time timer, so it comes when the stream's time passes it.

Outcomes are told apart by (address, attempt): one that isn't the open request's, as a repeated or late one is, changes
nothing. So a batch that runs again after a failure gives the same rows, and a stream that is started again goes on
where it was. State is a few numbers per key; a finished key keeps its own so that a late outcome cannot open it again.

``crawl`` runs the machine against landed responses, round by round, until no request is open: what a fetcher does outside.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

#: Requests per address, seconds before the second one, and seconds that an outcome may take.
MOST = 3
PAUSE = 60
PATIENCE = 3600
FOUND, MISSING = 200, 404
ADDRESSES = 2
OUTCOME = "address int, attempt int, status int, body string, at timestamp"
ANSWER = "kind string, address int, attempt int, due timestamp, body string, reason string"
#: The same as the machine gives it: times are milliseconds there.
_SAID = ("kind", "address", "attempt", "due", "body", "reason")
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Retries(StatefulProcessor):
    def __init__(self, key: str, most: int = MOST, pause: int = PAUSE, patience: int = PATIENCE):
        self.row, self.most, self.pause, self.patience = Row(key, *_SAID), most, pause, patience

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("page", "address int, attempt int, deadline long, closed boolean")

    def _row(self, key, kind: str, address: int, attempt: int, due: int | None = None, body: str | None = None, reason: str | None = None) -> Row:
        return self.row(key[0], kind, address, attempt, due, body, reason)

    def _open(self, key, address: int, attempt: int, now: int) -> Row:
        """Open a request: the n-th at an address waits twice as long as the one before."""
        due = now + (self.pause * 1000 * 2 ** (attempt - 2) if attempt > 1 else 0)
        deadline = due + self.patience * 1000
        self.state.update((address, attempt, deadline, False))
        self.handle.registerTimer(deadline)
        return self._row(key, "request", address, attempt, due)

    def _close(self, key, kind: str, address: int, attempt: int, **what) -> Row:
        self.state.update((address, attempt, 0, True))
        return self._row(key, kind, address, attempt, **what)

    def _next(self, key, address: int, attempt: int, status: int | None, body: str | None, now: int) -> Row:
        """What follows an open request's outcome."""
        if status == FOUND and body:
            return self._close(key, "done", address, attempt, body=body)
        gone = status in (FOUND, MISSING)
        if not gone and attempt < self.most:
            return self._open(key, address, attempt + 1, now)
        if address + 1 < ADDRESSES:
            return self._open(key, address + 1, 1, now)
        return self._close(key, "dead", address, attempt, reason="missing" if gone else "exhausted")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # the outcomes of one key in one batch are a few: at most its requests, and repeats of them
        met = sorted(rows, key=lambda r: (r.address is None, r.address or 0, r.attempt is None, r.attempt or 0, r.now))
        for r in met:
            state = self.state.get()
            if state is None:
                if r.attempt == 0:
                    yield self._open(key, 0, 1, r.now)
                continue
            address, attempt, deadline, closed = state
            if closed or (r.address, r.attempt) != (address, attempt):
                continue
            self.handle.deleteTimer(deadline)
            yield self._next(key, address, attempt, r.status, r.body, r.now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.state.get()
        if state is not None:
            address, attempt, deadline, closed = state
            if not closed and deadline <= expiredTimerInfo.getExpiryTimeInMs():
                yield self._next(key, address, attempt, None, None, deadline)

    def close(self) -> None:
        pass


def session(spark: SparkSession) -> SparkSession:
    """A session whose streams keep state in RocksDB, which state machines need; the caller's own stays as it is.

    State has as many partitions as the caller's shuffles, but no more than two for each core: each is a store of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    # a stream that ended leaves its stores open, some 4 MB of disk each at least, until the next round of maintenance
    own.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "5s")
    return own


def machine(outcomes: DataFrame, key: str, most: int = MOST, pause: int = PAUSE, patience: int = PATIENCE, late: str = "1 hour") -> DataFrame:
    """(key, kind, address, attempt, due, body, reason) for a stream of (key, address, attempt, status, body, at), made in ``session``.

    An outcome of attempt 0 asks for a page. Rows without a key are dropped: there is nothing to come back to.
    """
    stream = outcomes.where(F.col(key).isNotNull()).select(key, "address", "attempt", "status", "body", F.unix_millis("at").alias("now"), "at").withWatermark("at", late)
    kind = dict(outcomes.dtypes)[key]
    said = ANSWER.replace("due timestamp", "due long")
    made = stream.groupBy(key).transformWithState(Retries(key, most, pause, patience), f"`{key}` {kind}, {said}", "Append", "EventTime")
    return made.withColumn("due", F.timestamp_millis("due"))


def take_in(spark: SparkSession, folder: str, key: str, kind: str, **limits) -> None:
    """Run the machine over the outcomes that have landed in ``folder``/outcomes since it ran last; answers go to ``folder``/answers."""
    own = session(spark)
    landed = own.readStream.schema(f"`{key}` {kind}, {OUTCOME}").parquet(f"{folder}/outcomes")
    answers = machine(landed, key, **limits)
    answers.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/answers").awaitTermination()


def answers(spark: SparkSession, folder: str, key: str, kind: str) -> DataFrame:
    return spark.read.schema(f"`{key}` {kind}, {ANSWER}").parquet(f"{folder}/answers")


def crawl(spark: SparkSession, wanted: DataFrame, responses: DataFrame, key: str, folder: str, **limits) -> DataFrame:
    """The machine's answers for the ``wanted`` pages (key, at), each request answered by ``responses`` (key, address, attempt, status, body).

    A request that has no response gets an outcome without a status. Rounds are at most two addresses times ``most`` requests,
    and one to ask; each is a stream that takes in what landed. A crawl that was stopped goes on in the same folder.
    """
    kind = dict(wanted.dtypes)[key]
    columns = [key, "address", "attempt", "status", "body", "at"]
    null = lambda t: F.lit(None).cast(t)
    ask = wanted.select(key, F.lit(0).alias("address"), F.lit(0).alias("attempt"), null("int").alias("status"), null("string").alias("body"), "at")
    ask.write.mode("ignore").parquet(f"{folder}/outcomes")
    while True:
        take_in(spark, folder, key, kind, **limits)
        said = answers(spark, folder, key, kind)
        told = spark.read.schema(f"`{key}` {kind}, {OUTCOME}").parquet(f"{folder}/outcomes").select(key, "address", "attempt")
        asked = said.where("kind = 'request'").select(key, "address", "attempt", F.col("due").alias("at")).join(told, [key, "address", "attempt"], "left_anti")
        # a round asks for a few of the places at which a page may be, so only what was answered there has to be shuffled, text and all
        places = asked.select("address", "attempt").distinct().collect()
        if not places:
            return said
        there = reduce(or_, ((F.col("address") == r["address"]) & (F.col("attempt") == r["attempt"]) for r in places))
        asked.join(responses.where(there), [key, "address", "attempt"], "left").select(columns).write.mode("append").parquet(f"{folder}/outcomes")
