"""Scheduled runs: one query a source, one run at a time, a failing source doesn't stop the others."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from threading import Event, Thread

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from groundplan.functions.numeric import next_run


class Busy(RuntimeError):
    """Another scheduler holds the lease."""


class Lease:
    """An exclusive lease: a file in a folder that all schedulers share, with its holder and its end.

    It is taken by renaming a finished file to the lease's name, which fails where one exists; the file systems of clusters
    do that atomically. One that has ended is first renamed away, which only one of several takers can do. While it is held a
    thread renews it; `check` raises Busy if it has been lost, as after a pause longer than its length.
    """

    def __init__(self, spark: SparkSession, folder: str, seconds: float = 60.0, clock: Callable[[], float] = time.time):
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        none, over = (jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1) for _ in range(2))
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        none[0], over[0] = rename.NONE, rename.OVERWRITE
        self._none, self._over = none, over
        self.file, self.folder = f"{folder.rstrip('/')}/lease", folder.rstrip("/")
        self.seconds, self.clock, self.holder = seconds, clock, uuid.uuid4().hex
        self._stop = Event()
        self._io = jvm.org.apache.commons.io.IOUtils
        self._fs.mkdirs(self._path(folder))

    def _put(self, options) -> bool:
        """Write the lease under a name of its own, then rename it."""
        own = self._path(f"{self.folder}/.{self.holder}-{uuid.uuid4().hex}")
        out = self._fs.create(own, True)
        out.write(json.dumps({"holder": self.holder, "until": self.clock() + self.seconds}).encode())
        out.close()
        try:
            self._files.rename(own, self._path(self.file), options)
            return True
        except Py4JJavaError:
            self._fs.delete(own, False)
            return False

    def read(self) -> dict | None:
        """The lease as it stands; one that can't be read has ended."""
        try:
            with_stream = self._fs.open(self._path(self.file))
        except Py4JJavaError:
            return None
        try:
            return json.loads(self._io.toString(with_stream, "UTF-8"))
        except ValueError:
            return {"holder": "", "until": 0.0}
        finally:
            with_stream.close()

    def __enter__(self) -> Lease:
        if not self._put(self._none):
            there = self.read()
            if there and there["until"] > self.clock():
                raise Busy(f"another run holds the lease for {there['until'] - self.clock():.0f} s")
            gone = self._path(f"{self.folder}/.ended-{uuid.uuid4().hex}")
            try:
                self._files.rename(self._path(self.file), gone, self._none)
            except Py4JJavaError:
                pass  # another taker was first; the lease is its, or will be
            else:
                self._fs.delete(gone, False)
            if not self._put(self._none):
                raise Busy("another run has taken the lease over")
        self._stop.clear()
        self._thread = Thread(target=self._keep, daemon=True)
        self._thread.start()
        return self

    def _keep(self) -> None:
        while not self._stop.wait(self.seconds / 3):
            if not self.renew():
                return

    def renew(self) -> bool:
        there = self.read()
        return bool(there) and there["holder"] == self.holder and self._put(self._over)

    def check(self) -> None:
        there = self.read()
        if not there or there["holder"] != self.holder:
            raise Busy("the lease was lost")

    def __exit__(self, *error) -> None:
        self._stop.set()
        self._thread.join()
        there = self.read()
        if there and there["holder"] == self.holder:
            self._fs.delete(self._path(self.file), False)


@dataclass
class Outcome:
    """What became of each source of a run: rows read, and an error or None."""

    rows: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str | None] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not any(self.errors.values())


class Recorder(StreamingQueryListener):
    """Rows and ends of the queries whose run ids it is told."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802  Spark's name
        self.rows.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended[str(event.runId)] = event.exception


def run_once(spark: SparkSession, sources: dict[str, Callable[[SparkSession], StreamingQuery]], lease: Lease, after: Callable[[], None] | None = None, wait: float = 30.0) -> Outcome:
    """Start each source's query (which ends by itself) and wait for all; then `after`, such as building the final table.

    A source that fails, at its start or on its way, is reported with its error; all others run to their end. Busy if
    another scheduler holds the lease: nothing is started.
    """
    with lease:
        recorder, out, running = Recorder(), Outcome(), {}
        spark.streams.addListener(recorder)
        try:
            for name, start in sources.items():
                try:
                    running[name] = start(spark)
                except Exception as error:  # one source must not stop the run
                    out.errors[name], out.rows[name] = f"{type(error).__name__}: {error}"[:1000], 0
            for name, query in running.items():
                try:
                    query.awaitTermination()
                except Exception:  # its end is recorded with the error
                    pass
            until = time.monotonic() + wait
            while any(str(q.runId) not in recorder.ended for q in running.values()) and time.monotonic() < until:
                time.sleep(0.05)  # events come a little later than the end
            for name, query in running.items():
                error = recorder.ended.get(str(query.runId)) or (str(query.exception()) if query.exception() else None)
                out.errors[name], out.rows[name] = (error[:1000] if error else None), recorder.rows.get(str(query.runId), 0)
        finally:
            spark.streams.removeListener(recorder)
        lease.check()
        if after is not None:
            after()
        return out


def run_forever(
    once: Callable[[], Outcome], now: Callable, sleep: Callable[[float], None], tell: Callable[[str], None], at: str | None = None, every_hours: float | None = None, turns: int | None = None
) -> None:
    """Run at once, then at each time of the schedule; a run that is skipped or fails is told, and the schedule goes on."""
    done = 0
    while turns is None or done < turns:
        try:
            out = once()
            tell("; ".join(f"{name}: {out.errors[name] or f'{out.rows[name]} rows'}" for name in sorted(out.errors)))
        except Busy as error:
            tell(f"skipped: {error}")
        except Exception as error:
            tell(f"failed: {error}")
        done += 1
        if turns is None or done < turns:
            start = now()
            sleep(max(0.0, (next_run(start, at, every_hours) - start).total_seconds()))
