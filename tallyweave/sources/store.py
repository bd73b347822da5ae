"""Period tables with versions: candidates, acceptance, rollback, retention.

A store is a folder. ``data/batch=<id>/<period columns>/`` holds the rows of a
version, written once and never changed. ``manifest/<generation>.parquet`` lists
every version with its state, row count and content digest; the highest
generation is the state of the store. A change is made in two phases: data are
written first and are invisible, then a whole new manifest is put in place by one
exclusive rename. A reader sees the generation before or the one after, a failed
write leaves only files that no manifest names, and of two writers that start
from one generation the second gets :class:`Conflict` and can run again.

States: ``candidate`` (proposed), ``accepted`` (the one current version of its
period), ``rejected``, ``superseded`` (accepted before), ``withdrawn`` (rolled
back), ``retired`` (listed to be removed).

The manifest has one row for each period and version, whatever their size; data
never pass through the driver. Only file names and manifest rows do.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

CANDIDATE, ACCEPTED, REJECTED, SUPERSEDED, WITHDRAWN, RETIRED = "candidate", "accepted", "rejected", "superseded", "withdrawn", "retired"
_FIELDS = "version int, state string, batch string, rows long, digest string, changed int, generation int"


class Conflict(RuntimeError):
    """Another writer has changed the store meanwhile."""


def content_digest(columns: Sequence[str]) -> Column:
    """Aggregate that is equal for equal rows in any order: their number and two sums of row hashes."""
    plain = [F.col(f"`{c}`") for c in columns]
    sums = [F.sum(F.xxhash64(*seed, *plain).cast("decimal(20,0)")).cast("string") for seed in ([], [F.lit(1)])]
    return F.concat_ws("/", F.count(F.lit(1)).cast("string"), *sums)


class PeriodStore:
    """Versions of the periods of one table below ``path``; ``periods`` are its period columns (whole numbers)."""

    def __init__(self, spark: SparkSession, path: str, periods: Sequence[str]):
        self.spark, self.path, self.periods = spark, path.rstrip("/"), list(periods)
        self._jvm = spark.sparkContext._jvm
        self.schema = ", ".join(f"`{p}` long" for p in self.periods) + ", " + _FIELDS

    # Files

    def _files(self, path: str):
        hadoop = self._jvm.org.apache.hadoop.fs
        place = hadoop.Path(path)
        return hadoop.FileContext.getFileContext(place.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _names(self, path: str) -> list[str]:
        context, place = self._files(path)
        if not context.util().exists(place):
            return []
        return sorted(status.getPath().getName() for status in context.util().listStatus(place))

    def _remove(self, path: str) -> None:
        context, place = self._files(path)
        context.delete(place, True)

    # Manifest

    def generation(self) -> int:
        """Number of the current manifest, 0 for a new store."""
        return max((int(n.split(".")[0]) for n in self._names(f"{self.path}/manifest") if n.endswith(".parquet")), default=0)

    def manifest(self, generation: int | None = None) -> DataFrame:
        """Every version with its state, as of a generation (the current one by default)."""
        number = self.generation() if generation is None else generation
        if not number:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/manifest/{number:010d}.parquet")

    def _publish(self, rows: Iterable[Mapping], base: int) -> int:
        """Put a manifest in place of generation ``base``, or fail."""
        number = base + 1
        draft = f"{self.path}/drafts/{uuid.uuid4().hex}"
        listed = [tuple(r[c] for c in (*self.periods, "version", "state", "batch", "rows", "digest", "changed")) + (number,) for r in rows]
        self.spark.createDataFrame(listed, self.schema).coalesce(1).write.parquet(draft)
        part = next(n for n in self._names(draft) if n.endswith(".parquet"))
        context, source = self._files(f"{draft}/{part}")
        _, folder = self._files(f"{self.path}/manifest")
        _, target = self._files(f"{self.path}/manifest/{number:010d}.parquet")
        hadoop = self._jvm.org.apache.hadoop.fs
        context.mkdir(folder, hadoop.permission.FsPermission.getDirDefault(), True)
        try:
            context.rename(source, target, self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"generation {number} of {self.path} was published meanwhile") from error
            raise
        finally:
            self._remove(draft)
        return number

    def _listed(self) -> tuple[int, list[dict]]:
        base = self.generation()
        return base, [r.asDict() for r in self.manifest(base).collect()]

    def _key(self, row: Mapping | Row) -> tuple:
        return tuple(row[p] for p in self.periods)

    # Reading

    def _paths(self, rows: Iterable[Mapping]) -> list[str]:
        return [f"{self.path}/data/batch={r['batch']}/" + "/".join(f"{p}={r[p]}" for p in self.periods) for r in rows]

    def _read(self, rows: list[Mapping]) -> DataFrame:
        if not rows:
            raise LookupError(f"{self.path}: no such version")
        reader = self.spark.read.option("basePath", f"{self.path}/data").option("mergeSchema", True)
        found = reader.parquet(*self._paths(rows)).drop("batch")
        return found.withColumns({p: F.col(p).cast("long") for p in self.periods})

    def current(self, generation: int | None = None) -> DataFrame:
        """Rows of the accepted version of every period, read from the folders the manifest names.

        The manifest is read once, here: later changes of the store do not touch this frame.
        """
        listed = [r.asDict() for r in self.manifest(generation).filter(F.col("state") == ACCEPTED).collect()]
        return self._read(listed)

    def version(self, number: int, **period: int) -> DataFrame:
        """Rows of one version, whatever its state."""
        match = [r for r in self._listed()[1] if r["version"] == number and self._key(r) == self._key(period)]
        return self._read(match)

    # Changes

    def _content(self, df: DataFrame) -> list[Row]:
        columns = sorted(c for c in df.columns if c not in self.periods)
        return df.groupBy(*self.periods).agg(F.count(F.lit(1)).alias("rows"), content_digest(columns).alias("digest")).collect()

    def propose(self, df: DataFrame, only_changed: bool = False, files_per_period: int = 16) -> list[dict]:
        """Write ``df`` as a candidate version of every period it holds; returns the new manifest rows.

        With ``only_changed`` periods whose content equals their accepted version
        are not written. Rows without a period are an error. Row counts and
        digests are those of the written files.
        """
        base, listed = self._listed()
        df = df.withColumns({p: F.col(p).cast("long") for p in self.periods})
        if df.filter(reduce(lambda a, b: a | b, [F.col(p).isNull() for p in self.periods])).limit(1).count():
            raise ValueError(f"rows without {self.periods}")
        if only_changed:
            same = {(self._key(r), r["digest"]) for r in listed if r["state"] == ACCEPTED}
            changed = [self._key(r) for r in self._content(df) if (self._key(r), r["digest"]) not in same]
            if not changed:
                return []
            keys = self.spark.createDataFrame(changed, ", ".join(f"`{p}` long" for p in self.periods))
            df = df.join(F.broadcast(keys), self.periods)  # one row a period
        batch = uuid.uuid4().hex
        content = [f"`{c}`" for c in df.columns if c not in self.periods]
        spread = df.repartition(*self.periods, F.pmod(F.xxhash64(*content), F.lit(files_per_period))) if content else df
        spread.write.partitionBy(*self.periods).parquet(f"{self.path}/data/batch={batch}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.path}/data/batch={batch}")
        newest: dict[tuple, int] = {}
        for row in listed:
            newest[self._key(row)] = max(newest.get(self._key(row), 0), row["version"])
        new = [
            dict(zip(self.periods, self._key(r), strict=True))
            | {"version": newest.get(self._key(r), 0) + 1, "state": CANDIDATE, "batch": batch, "rows": r["rows"], "digest": r["digest"], "changed": base + 1}
            for r in self._content(written)
        ]
        if new:
            self._publish([*listed, *new], base)
        return new

    def _change(self, decide) -> int:
        base, listed = self._listed()
        decide(listed, base + 1)
        return self._publish(listed, base)

    def _set(self, listed: list[dict], rows: Iterable[Mapping], state: str, wanted: str, number: int) -> list[dict]:
        by = {(self._key(r), r["version"]): r for r in listed}
        out = []
        for row in rows:
            found = by.get((self._key(row), row["version"]))
            if found is None or found["state"] != wanted:
                raise ValueError(f"{self._key(row)} version {row['version']} is {found['state'] if found else 'unknown'}, not {wanted}")
            found |= {"state": state, "changed": number}
            out.append(found)
        return out

    def accept(self, versions: Iterable[Mapping]) -> int:
        """Candidates become current, all in one step; what was accepted before is superseded."""
        versions = list(versions)

        def decide(listed: list[dict], number: int) -> None:
            chosen = self._set(listed, versions, ACCEPTED, CANDIDATE, number)
            periods = [self._key(c) for c in chosen]
            if len(set(periods)) < len(periods):
                raise ValueError("two versions of one period accepted at once")
            ids = {id(c) for c in chosen}
            for row in listed:
                if row["state"] == ACCEPTED and id(row) not in ids and self._key(row) in set(periods):
                    row |= {"state": SUPERSEDED, "changed": number}

        return self._change(decide)

    def reject(self, versions: Iterable[Mapping]) -> int:
        """Candidates that are not to become current."""
        versions = list(versions)
        return self._change(lambda listed, number: self._set(listed, versions, REJECTED, CANDIDATE, number))

    def roll_back(self, **period: int) -> int:
        """Withdraw the current version of a period; the one accepted before it is current again."""

        def decide(listed: list[dict], number: int) -> None:
            own = [r for r in listed if self._key(r) == self._key(period)]
            before = max((r for r in own if r["state"] == SUPERSEDED), key=lambda r: (r["changed"], r["version"]), default=None)
            now = next((r for r in own if r["state"] == ACCEPTED), None)
            if now is None or before is None:
                raise ValueError(f"nothing to go back to for {period}")
            now |= {"state": WITHDRAWN, "changed": number}
            before |= {"state": ACCEPTED, "changed": number}

        return self._change(decide)

    def write_back(self, df: DataFrame) -> list[dict]:
        """Accept ``df`` for the periods whose content differs from the current one; others stay untouched."""
        new = self.propose(df, only_changed=True)
        if new:
            self.accept(new)
        return new

    # Retention

    def retire(self, newest: int) -> int:
        """List as retired all but the accepted versions of the ``newest`` periods; nothing is removed yet."""

        def decide(listed: list[dict], number: int) -> None:
            kept = set(sorted({self._key(r) for r in listed if r["state"] == ACCEPTED})[-newest:] if newest else ())
            for row in listed:
                if row["state"] not in (RETIRED, CANDIDATE) and not (row["state"] == ACCEPTED and self._key(row) in kept):
                    row |= {"state": RETIRED, "changed": number}

        return self._change(decide)

    def sweep(self, grace: int = 1, orphan_seconds: float = 86_400) -> list[str]:
        """Remove the folders of versions retired at least ``grace`` generations ago; returns what was removed.

        They leave the manifest first. Readers that planned against one of the
        last ``grace`` generations keep their files. Folders that no manifest row
        names, left by failed writes, go once unchanged for ``orphan_seconds``.
        """
        base, listed = self._listed()
        gone = [r for r in listed if r["state"] == RETIRED and base - r["changed"] >= grace]
        paths = self._paths(gone)
        ids = {id(r) for r in gone}
        if gone:
            self._publish([r for r in listed if id(r) not in ids], base)
        for path in paths:
            self._remove(path)
        kept = {r["batch"] for r in listed if id(r) not in ids}
        emptied = {r["batch"] for r in gone} - kept
        for name in self._names(f"{self.path}/data"):
            batch = name.removeprefix("batch=")
            folder = f"{self.path}/data/{name}"
            context, place = self._files(folder)
            age = time.time() - context.getFileStatus(place).getModificationTime() / 1000
            if batch in emptied or batch not in kept and age >= orphan_seconds:
                self._remove(folder)
                paths.append(folder)
        return paths

    def compact(self, target_bytes: int) -> list[dict]:
        """Rewrite accepted versions whose files are much smaller than ``target_bytes`` into fewer ones.

        The rows and the version stay the same, only their folder changes; the old
        folder is listed as a retired version 0 until it is swept.
        """
        base, listed = self._listed()
        small: list[tuple[dict, int]] = []
        for row, path in zip(*(lambda rows: (rows, self._paths(rows)))([r for r in listed if r["state"] == ACCEPTED]), strict=True):
            context, place = self._files(path)
            sizes = [s.getLen() for s in context.util().listStatus(place) if s.getPath().getName().endswith(".parquet")]
            wanted = max(1, -(-sum(sizes) // target_bytes))
            if len(sizes) > wanted:
                small.append((row, wanted))
        if not small:
            return []
        batch = uuid.uuid4().hex
        parts = [self._read([row]).coalesce(wanted) for row, wanted in small]
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        whole.write.partitionBy(*self.periods).parquet(f"{self.path}/data/batch={batch}")
        for row, _ in small:
            listed.append(row | {"version": 0, "state": RETIRED, "changed": base + 1})
            row |= {"batch": batch, "changed": base + 1}
        self._publish(listed, base)
        return [row for row, _ in small]
