"""Parquet tables that change together (K4-K9).

Every table is a folder partitioned by load. A load writes its own partitions,
so a retry overwrites and never doubles them, and becomes visible to readers
only when its commit row is written, last. Readers take the newest commit and
prune the partitions of unfinished loads by their number.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postmill.operators.metrics import StepTimer
from postmill.operators.rules import CHOICES, FAIL, QUARANTINE, REPORT, first_break, refused
from postmill.schema import AUDITS, KEY_INDEX, LEDGER, MAIN, PROFILES, REJECTS, STAGING, TIMINGS, TableSpec
from postmill.sources.tables import declared_empty, seed_languages

_COMMITS = "kind string, load_id bigint"
#: Files of commits that a reader opens at most, about; one more and they become one.
COMMIT_FILES = 32

SPECS: dict[str, TableSpec] = {
    **STAGING,
    **MAIN,
    **{spec.name: spec for spec in (REJECTS, TIMINGS, PROFILES, LEDGER, KEY_INDEX, AUDITS)},
}

_BROKEN = {"rule": "string", "on": "string", "row": "string"}


class Store:
    """Tables under one shared folder."""

    def __init__(self, spark: SparkSession, root: str, lease: float = 3600) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.lease = lease

    # ------------------------------------------------------------- writers

    @contextmanager
    def writing(self, patience: float = 3600) -> Iterator[None]:
        """K9, T4: the right to publish, for one writer at a time; others wait.

        The right is a file that can be created once. A writer that died leaves its
        file; when that is older than ``lease`` seconds the next number is created in
        its place, which again only one can do. A writer that has been overtaken so
        is told by :meth:`publish` and publishes nothing.
        """
        deadline = time.monotonic() + patience
        while (mine := self._claimed()) is None:
            if time.monotonic() > deadline:
                raise TimeoutError(f"another writer has held {self.root} for {patience} s")
            time.sleep(0.2)
        self._mine = mine
        try:
            yield
        finally:
            if self._holds():
                self.remove(f"writing/{mine[0]}")
            self._mine = None

    # Number of the claim and the word written into it, while this object has the right.
    _mine: tuple[int, str] | None = None

    def _holds(self) -> bool:
        """Whether the newest claim is this object's own."""
        number, word = self._mine
        if self._claims()[-1:] != [number]:
            return False
        file, files = self._folder(f"writing/{number}")
        stream = files.open(file)
        try:
            return bytes(stream.readAllBytes()).decode() == word
        finally:
            stream.close()

    def _claims(self) -> list[int]:
        return sorted(int(path.getName()) for path in self._inside("writing") if path.getName().isdigit())

    def _claimed(self) -> tuple[int, str] | None:
        """Number and word of a claim of one's own, None while another one holds."""
        held = self._claims()
        if held:
            folder, files = self._folder(f"writing/{held[-1]}")
            if not files.exists(folder):
                return None
            changed = files.getFileStatus(folder).getModificationTime() / 1000
            if time.time() - changed < self.lease:
                return None
        number = held[-1] + 1 if held else 1
        if not self._created_once(f"writing/{number}"):
            return None
        # A holder may have come and gone between the two looks; only the newest claim counts.
        if self._claims()[-1] != number:
            self.remove(f"writing/{number}")
            return None
        word = uuid.uuid4().hex
        file, files = self._folder(f"writing/{number}")
        stream = files.create(file, True)
        stream.write(bytearray(word.encode()))
        stream.close()
        for dead in held:
            self.remove(f"writing/{dead}")
        return number, word

    def _created_once(self, path: str) -> bool:
        """Create an empty file unless it is there: of several who try, one succeeds."""
        file, files = self._folder(path)
        files.mkdirs(file.getParent())
        if files.getUri().getScheme() == "file":  # that file system's own create would not tell
            return self.spark.sparkContext._jvm.java.io.File(file.toUri().getPath()).createNewFile()
        try:
            files.create(file, False).close()
        except Py4JJavaError:
            if files.exists(file):
                return False
            raise
        return True

    def _require_right(self) -> None:
        if self._mine is not None and not self._holds():
            raise RuntimeError("another writer has taken over, as this one held the store too long")

    # ------------------------------------------------------------- commits

    def _commit_files(self) -> list[str]:
        return sorted(path.getName() for path in self._inside("commits") if path.getName().endswith(".parquet"))

    def _newest_in(self, files: list[str]) -> dict[str, int]:
        if not files:
            return {}
        rows = self.spark.read.schema(_COMMITS).parquet(*(f"{self.root}/commits/{file}" for file in files))
        newest = rows.groupBy("kind").agg(F.max("load_id").alias("n"))
        return {row["kind"]: row["n"] for row in newest.collect()}

    def marks(self) -> dict[str, int]:
        """Newest load of each kind of commit, a handful in all.

        Files that have meanwhile become one are looked for anew: their marks stand in
        a file that was there before they went.
        """
        while True:
            files = self._commit_files()
            try:
                return self._newest_in(files)
            except (PySparkException, Py4JJavaError):
                if all(self._there(f"commits/{file}") for file in files):
                    raise

    def _fold_commits(self) -> None:
        """K8: put one file with the marks of all in place of many, while loads run.

        Marks only rise, so the order of commits does not matter, and a commit that comes
        meanwhile has a file that is not among these. Their marks are written before
        they go; cut short, a mark stands twice, which changes nothing.
        """
        files = self._commit_files()
        if len(files) > COMMIT_FILES:
            self._append_marks(self._newest_in(files))
            for file in files:
                self.remove(f"commits/{file}")

    def publish(self, marks: dict[str, int]) -> None:
        """K9: raise marks, all of them at once, as one new file. Raising the
        mark of a kind makes all tables of its loads visible together."""
        self._require_right()
        self._append_marks(marks)
        self._fold_commits()

    def _append_marks(self, marks: dict[str, int]) -> None:
        pairs = [
            F.struct(F.lit(kind).alias("kind"), F.lit(load_id).cast("bigint").alias("load_id"))
            for kind, load_id in marks.items()
        ]
        rows = self.spark.range(1, numPartitions=1).select(F.inline(F.array(*pairs)))
        rows.write.mode("append").parquet(f"{self.root}/commits")

    def committed(self, kind: str) -> int:
        """Newest finished load of ``stage``, ``main`` or ``merged``."""
        return self.marks().get(kind, 0)

    def require_free(self, kind: str, load_id: int) -> None:
        """K9: refuse a load number that is published already."""
        newest = self.committed(kind)
        if load_id <= newest:
            raise RuntimeError(f"{kind} load {load_id} is taken, the newest is {newest}")

    # --------------------------------------------------------------- reads

    def _kind(self, name: str) -> str:
        if name in MAIN or name == KEY_INDEX.name:
            return "main"
        return "stage" if name in STAGING or name == REJECTS.name else name

    def read(self, name: str, after: int = 0, marks: dict[str, int] | None = None) -> DataFrame:
        """The committed rows of a table, or those of loads later than ``after``."""
        return self.read_by_load(name, after, marks).drop("load_id")

    def read_by_load(self, name: str, after: int = 0, marks: dict[str, int] | None = None) -> DataFrame:
        """The rows that :meth:`read` gives, with the number of their load."""
        return self._visible(name, SPECS[name].columns, name, after, marks)

    def _visible(
        self,
        folder: str,
        columns: dict[str, str],
        name: str,
        after: int,
        marks: dict[str, int] | None,
        spark: SparkSession | None = None,
    ) -> DataFrame:
        kind, columns = self._kind(name), {**columns, "load_id": "bigint"}
        marks = self.marks() if marks is None else marks
        low, high = max(after, marks.get(f"{kind}-reset", 0)), marks.get(kind, 0)
        if high <= low or not self._there(folder):
            return declared_empty(spark or self.spark, columns)
        ddl = ", ".join(f"`{column}` {kind}" for column, kind in columns.items())
        rows = (spark or self.spark).read.schema(ddl).parquet(f"{self.root}/{folder}")
        return rows.where((F.col("load_id") > low) & (F.col("load_id") <= high))

    @cached_property
    def _footers(self) -> SparkSession:
        """A session with settings of its own, in which counts and largest values of
        Parquet tables are taken from the footers of their files."""
        session = self.spark.newSession()
        others = [source for source in session.conf.get("spark.sql.sources.useV1SourceList").split(",") if source != "parquet"]
        session.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return session

    def footer_totals(self, name: str, key: str, marks: dict[str, int] | None = None) -> DataFrame:
        """One row: ``n`` and ``largest`` of the committed rows of a table. The frame belongs
        to a session of its own and cannot be joined with others; see :meth:`totals`."""
        rows = self._visible(name, SPECS[name].columns, name, 0, marks, self._footers)
        return rows.agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("largest"))

    def totals(self, name: str, key: str, marks: dict[str, int] | None = None) -> tuple[int, int]:
        """How many rows a table has and its largest ``key``, a whole number, 0
        without rows. The work grows with the number of files; no row is read."""
        row = self.footer_totals(name, key, marks).first()
        return row["n"] or 0, row["largest"] or 0  # without a file the pushed count is a null sum

    def loads_after_reset(self, name: str, marks: dict[str, int]) -> range:
        """The numbers of the loads whose rows :meth:`read` gives."""
        kind = self._kind(name)
        return range(marks.get(f"{kind}-reset", 0) + 1, marks.get(kind, 0) + 1)

    def broken(self, name: str, marks: dict[str, int] | None = None) -> DataFrame:
        """K5: the rows of committed loads that a table refused, as JSON, with the first
        rule each breaks."""
        return self._visible(f"broken/{name}", _BROKEN, name, 0, marks).drop("load_id")

    def main(self, marks: dict[str, int] | None = None) -> dict[str, DataFrame]:
        """The main tables, all as of one commit."""
        marks = self.marks() if marks is None else marks
        return {name: self.read(name, marks=marks) for name in MAIN}

    def staging(self, marks: dict[str, int] | None = None, waiting_only: bool = False) -> dict[str, DataFrame]:
        """The staging tables, all as of one commit; ``waiting_only`` leaves out
        the loads that have been merged."""
        marks = self.marks() if marks is None else marks
        after = marks.get("merged", 0) if waiting_only else 0
        return {name: self.read(name, after, marks) for name in STAGING}

    # -------------------------------------------------------------- writes

    def write(
        self, name: str, rows: DataFrame, load_id: int, timer: StepTimer | None = None, on_break: str = REPORT
    ) -> DataFrame:
        """K5, K6: put the columns of a table, by its own order, into the
        partition of a load; returns the written rows, read back. ``timer``
        notes how many rows that were.

        ``on_break`` says what becomes of rows that break a rule of the table:
        ``report`` writes them and leaves them to the audit, ``fail`` ends the job at
        the first, ``quarantine`` puts them into :meth:`broken` instead. The verdict is
        part of the one scan that writes; only where it has found broken rows are the
        rows computed again to put those aside.
        """
        if on_break not in CHOICES:
            raise ValueError(f"on_break is one of {CHOICES}, not {on_break!r}")
        spec, path = SPECS[name], f"{self.root}/{name}/load_id={load_id}"
        ordered, seen = rows.select(*spec.columns), Observation()
        if on_break == FAIL:
            ordered = refused(ordered, spec)
        elif on_break == QUARANTINE:
            judged = ordered.withColumn("_broken", first_break(spec))
            counted = judged.observe(seen, F.count("_broken").alias("n"))
            ordered = counted.where(F.col("_broken").isNull()).drop("_broken")
        if timer is not None:
            ordered = timer.observe(ordered, name)
        ordered.write.mode("overwrite").parquet(path)
        if timer is not None:
            timer.note(name)
        if on_break == QUARANTINE:
            self.remove(f"broken/{name}/load_id={load_id}")
            if seen.get["n"]:
                whole = F.to_json(F.struct(*spec.columns)).alias("row")
                aside = judged.where(F.col("_broken").isNotNull()).select("_broken.rule", "_broken.on", whole)
                aside.write.mode("overwrite").parquet(f"{self.root}/broken/{name}/load_id={load_id}")
        return self.spark.read.schema(spec.ddl).parquet(path)

    def reset(self, *kinds: str) -> None:
        """K8: empty all tables of some kinds by raising the mark below which
        loads are ignored, so numbers start again at 1."""
        with self.writing():
            marks = self.marks()
            self.publish({f"{kind}-reset": marks.get(kind, 0) for kind in kinds})

    def reset_all(self) -> None:
        """Empty everything and seed the languages, in one commit."""
        with self.writing():
            marks = self.marks()
            load_id = marks.get("main", 0) + 1
            self.write("languages", seed_languages(self.spark), load_id)
            kinds = ("main", "stage", TIMINGS.name, PROFILES.name, LEDGER.name, AUDITS.name)
            self.publish({**{f"{kind}-reset": marks.get(kind, 0) for kind in kinds}, "main": load_id})

    # ------------------------------------------------------------- removal

    def _folder(self, path: str):
        """A folder of the store and the file system it is on."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())

    def _inside(self, path: str) -> list:
        folder, files = self._folder(path)
        return [status.getPath() for status in files.listStatus(folder)] if files.exists(folder) else []

    def _there(self, path: str) -> bool:
        folder, files = self._folder(path)
        return files.exists(folder)

    def remove(self, path: str) -> None:
        """Remove a folder of the store, if it is there."""
        folder, files = self._folder(path)
        files.delete(folder, True)

    def purge(self) -> None:
        """K8: remove what resets have emptied, and write the commits anew as one file.

        For quiet times: nothing else may read or write the store meanwhile. A
        purge that is cut short leaves the same marks and may be run again.
        """
        marks = self.marks()
        if not marks:
            return
        self._require_right()
        old = self._commit_files()
        self._append_marks(marks)
        for file in old:
            self.remove(f"commits/{file}")
        for name in SPECS:
            emptied = marks.get(f"{self._kind(name)}-reset", 0)
            for table in (name, f"broken/{name}"):
                for folder in self._inside(table):
                    number = folder.getName().removeprefix("load_id=")
                    if number.isdigit() and int(number) <= emptied:
                        self.remove(f"{table}/{folder.getName()}")
