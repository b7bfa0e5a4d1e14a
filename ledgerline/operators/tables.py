"""Parquet tables kept in parts, of which a merge reads and writes only those that the batch meets.

A small manifest per version lists the parts: their folders, row counts and the range of one chosen column. A commit writes new folders
first and then one new manifest, by a rename that fails if the version is there already. So a failed merge leaves the old state, readers
never see half of a merge, and two writers cannot both win. A commit can carry a batch number: a batch that was committed
before is not applied again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize

PART = "_part"
#: Rows of a part of a hashed table; a larger part is split by further bits of the hash.
PART_ROWS = 1_000_000
#: Digits of a hash.
BITS = 64
#: What a NULL partition value is called, and the part of all hashes.
NONE, ROOT = "none", "r"

Combine = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass
class Manifest:
    version: int = 0
    batch: int | None = None
    schema: str | None = None
    parts: dict[str, list[dict]] = field(default_factory=dict)


def plain(value):
    """A value as JSON keeps it and in its order: numbers as they are, dates and times as text."""
    return value if value is None or isinstance(value, (int, float)) else str(value)


class PartTable:
    """A table in parts by the value of ``by``; ``mark`` names the column whose range the manifest keeps."""

    def __init__(self, spark: SparkSession, root: str, by: str | None = None, mark: str | None = None) -> None:
        self.spark, self.root, self.by, self.mark = spark, root.rstrip("/"), by, mark

    # ------------------------------------------------------------ manifest

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        base = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm, base.getFileSystem(conf), base, conf

    def manifest(self) -> Manifest:
        """The newest version; an empty one if there is no table yet."""
        jvm, fs, base, _ = self._fs()
        if not fs.exists(base):
            return Manifest()
        versions = [int(s.getPath().getName()[2:-5]) for s in fs.listStatus(base) if s.getPath().getName().startswith("v=")]
        if not versions:
            return Manifest()
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/v={max(versions)}.json"))
        try:
            return Manifest(**json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _publish(self, new: Manifest) -> None:
        jvm, fs, _, conf = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        part, final = path(f"{self.root}/manifest/_{uuid.uuid4().hex}"), path(f"{self.root}/manifest/v={new.version}.json")
        out = fs.create(part, False)
        out.write(json.dumps(new.__dict__).encode())
        out.close()
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(part, final, none)

    # ------------------------------------------------------------ reading

    def read(self, parts: Iterable[str] | None = None, at: Manifest | None = None) -> DataFrame | None:
        """Rows of the named parts (default: all), with their part in ``_part``; None before the first commit."""
        at = at or self.manifest()
        if at.schema is None:
            return None
        chosen = at.parts if parts is None else {p: at.parts[p] for p in parts if p in at.parts}
        paths = [f["path"] for files in chosen.values() for f in files]
        rows = self.spark.createDataFrame([], at.schema)
        if not paths:
            return rows
        return self.spark.read.schema(rows.schema).option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/{p}" for p in paths]).select(*rows.columns)

    def meeting(self, low, high) -> list[str]:
        """Parts whose range of the marked column meets ``low..high``, from the manifest alone."""
        wanted, low, high = [], plain(low), plain(high)
        for part, files in self.manifest().parts.items():
            if any(f["low"] is not None and f["low"] <= high and f["high"] >= low for f in files):
                wanted.append(part)
        return wanted

    # ------------------------------------------------------------ writing

    def placed(self, rows: DataFrame, at: Manifest) -> DataFrame:
        return rows.withColumn(PART, F.coalesce(F.col(self.by).cast("string"), F.lit(NONE)))

    def _write(self, rows: DataFrame, version: int) -> dict[str, list[dict]]:
        """New folders of a version and their manifest entries."""
        folder = f"_commit={version}-{uuid.uuid4().hex[:8]}"
        target = f"{self.root}/data/{folder}"
        rows.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(target)
        schema = rows.schema
        written = self.spark.read.schema(schema).parquet(target)
        low, high = (F.min(self.mark), F.max(self.mark)) if self.mark else (F.lit(None), F.lit(None))
        found: dict[str, list[dict]] = {}
        # one row per part of this commit
        for r in written.groupBy(PART).agg(F.count("*").alias("rows"), low.alias("low"), high.alias("high")).collect():
            name = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(r[PART])
            found[r[PART]] = [{"path": f"{folder}/{PART}={name}", "rows": r["rows"], "low": plain(r["low"]), "high": plain(r["high"])}]
        return found

    def commit(self, rows: DataFrame, replaced: Iterable[str], at: Manifest, batch: int | None = None) -> Manifest:
        """Publish the next version: ``replaced`` parts go, the parts of ``rows`` (with ``_part``) come; others stay."""
        schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != PART) + f", {PART} string"
        fresh = self._write(rows, at.version + 1)
        gone = set(replaced)
        parts = {p: f for p, f in at.parts.items() if p not in gone} | {g: [] for g in self.gaps(gone, set(fresh), at)}
        for p, files in fresh.items():
            parts[p] = parts.get(p, []) + files
        new = Manifest(at.version + 1, at.batch if batch is None else batch, schema, parts)
        self._publish(new)
        return new

    def merge(self, new: DataFrame, combine: Combine, batch: int | None = None) -> list[str]:
        """Replace the parts that occur in ``new`` by ``combine(new, their old rows)``; returns these parts."""
        at = self.manifest()
        if batch is not None and at.batch is not None and batch <= at.batch:
            return []
        fresh = materialize(self.placed(new, at), "batch")
        touched = sorted(r[0] for r in fresh.select(PART).distinct().collect())
        if not touched:
            return []
        old = self.read(touched, at)
        old = fresh.drop(PART).limit(0) if old is None else old.drop(PART)
        result = combine(fresh.drop(PART), old)
        self.commit(self.resized(self.placed(result, at), at), touched, at, batch)
        return touched

    def resized(self, rows: DataFrame, at: Manifest) -> DataFrame:
        return rows

    def gaps(self, replaced: Iterable[str], found: set[str], at: Manifest) -> list[str]:
        """Parts that stay in the manifest without rows."""
        return []

    def append(self, new: DataFrame, key: Sequence[str]) -> DataFrame:
        """Add the rows of ``new`` whose key their part does not hold yet, as further files; returns the rows added."""
        at = self.manifest()
        fresh = materialize(self.placed(new, at), "batch")
        touched = [r[0] for r in fresh.select(PART).distinct().collect()]
        old = self.read(touched, at)
        added = materialize(fresh if old is None else fresh.join(old.select(*key), list(key), "left_anti").select(*fresh.columns), "added")
        if touched:
            self.commit(added, [], at)
        return added.drop(PART)

    def snapshot(self, rows: DataFrame, as_of: str, full_refresh: bool = False) -> None:
        """Add one dated copy of ``rows`` (``by`` is its day); a rerun of the day replaces that day only.

        Earlier days cannot be computed again, so a full refresh is refused.
        """
        if full_refresh:
            raise ValueError("a full refresh would lose the snapshots of earlier days")
        at = self.manifest()
        dated = rows.withColumn(self.by, F.lit(as_of).cast("date"))
        self.commit(self.placed(dated, at), [as_of], at)

    def vacuum(self, keep: int = 2) -> None:
        """Delete folders and manifests that none of the newest ``keep`` versions uses."""
        jvm, fs, base, _ = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        newest = self.manifest().version
        used = set()
        for version in range(max(1, newest - keep + 1), newest + 1):
            stream = fs.open(path(f"{self.root}/manifest/v={version}.json"))
            used |= {f["path"] for files in json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["parts"].values() for f in files}
            stream.close()
        for status in fs.listStatus(path(f"{self.root}/data")):
            folder = status.getPath()
            for part in fs.listStatus(folder):
                if part.isDirectory() and f"{folder.getName()}/{part.getPath().getName()}" not in used:
                    fs.delete(part.getPath(), True)
        for status in fs.listStatus(base):
            name = status.getPath().getName()
            if name.startswith("v=") and int(name[2:-5]) <= newest - keep:
                fs.delete(status.getPath(), False)


class HashTable(PartTable):
    """A keyed table in parts by the leading bits of the key's hash; a part that outgrows ``part_rows`` is split by more bits.

    Only the parts of a batch's keys are read and written, and they stay of one size however large the table grows.
    """

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], part_rows: int = PART_ROWS, mark: str | None = None) -> None:
        super().__init__(spark, root, None, mark)
        self.key, self.part_rows = list(key), part_rows

    def bits(self) -> Column:
        return F.concat(F.lit(ROOT), F.lpad(F.bin(F.xxhash64(*self.key)), BITS, "0"))

    def placed(self, rows: DataFrame, at: Manifest) -> DataFrame:
        if not at.parts:
            return rows.withColumn(PART, F.lit(ROOT))
        # parts are a prefix-free cover of all hashes: exactly one prefix of a hash is a part
        depths = sorted({len(p) for p in at.parts})
        listed = self.spark.createDataFrame([(p,) for p in at.parts], f"{PART} string")
        cut = F.explode(F.array(*[F.substring(self.bits(), 1, d) for d in depths]))
        # the list of parts is the manifest, which the driver holds
        return rows.withColumn(PART, cut).join(F.broadcast(listed), PART, "left_semi").select(*rows.columns, PART)

    def resized(self, rows: DataFrame, at: Manifest) -> DataFrame:
        """Parts above the limit, dealt by as many further bits as their rows need.

        Both halves of a split are parts from then on, also an empty one: it keeps the cover whole.
        """
        rows = materialize(rows, "merged")
        counts = rows.groupBy(PART).count().where(F.col("count") > self.part_rows).collect()
        if not counts:
            return rows
        more = {r[PART]: min(BITS + 1 - len(r[PART]), (-(-r["count"] // self.part_rows) - 1).bit_length()) for r in counts}
        split = self.spark.createDataFrame([(p, len(p) + d) for p, d in more.items()], f"{PART} string, _depth int")
        dealt = rows.join(F.broadcast(split), PART, "left")
        return dealt.withColumn(PART, F.when(F.col("_depth").isNull(), F.col(PART)).otherwise(self.bits().substr(F.lit(1), F.col("_depth")))).drop("_depth")

    def gaps(self, replaced: Iterable[str], found: set[str], at: Manifest) -> list[str]:
        return [g for p in (replaced if at.parts else [ROOT]) for g in uncovered(p, found)]


def uncovered(part: str, found: set[str]) -> list[str]:
    """The largest prefixes under ``part`` that no prefix of ``found`` shares."""
    if part in found:
        return []
    below = {f for f in found if f.startswith(part)}
    if not below:
        return [part]
    return uncovered(part + "0", below) + uncovered(part + "1", below)
