"""Tables kept as one current row per key.

Where the Delta package is on the classpath it does the merge. Without it a table is a
folder of plain parquet writes, each complete once Spark has left its `_SUCCESS` file:

    <table>/v=00000001-part-<writer>    the latest row per key of one upsert
    <table>/v=00000002-full-<writer>    the whole state
    <table>/_folded/<full write>        the names of the writes that a full one holds

An upsert writes only its own rows, so its cost does not depend on the table's size. A
read takes the last full write and lets the parts that it does not hold replace the keys
they name: only the rows of those keys are compared, the rest of the full state passes
through. Folding the parts in is the work of `compact` alone; `vacuum` removes folders out
of use. With `buckets` a write is laid out in folders by a hash of the key, and a read opens
only the buckets of the full state that some part has touched; the others go through as
they are.

Writers may run side by side and need no lock: a write is known by its number and its
writer's own id, so two that take the same number both count, also on stores where a create
is not exclusive. A full write says by name what it holds, so a part that ends later, under
whatever number, is read on top of it. A write that failed has no `_SUCCESS` and is nothing
to anyone; one that is named by its caller (a stream's query and batch) is taken over by the
retry, or found complete and not written again.
"""

from __future__ import annotations

import math
import re
import time
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.latest import Groups, latest_by, top_n_by
from ledgerlake.session import cut_lineage

SUCCESS = "_SUCCESS"
DELETED = "_deleted"
# a file is written by one task, which is sent its rows: several times what they take when stored
TARGET_BYTES = 32 << 20
RETENTION_HOURS = 168
FOLDED = "_folded"
MOST_BUCKETS = 4096
# parts of this share of the first write and more are merged with it in one exchange
MOST_PARTS = 2
_BUCKET = "_bucket_"
_WRITE = "_v"


@dataclass(frozen=True)
class Version:
    number: int
    full: bool
    path: str
    committed_ms: int

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[1]


@dataclass(frozen=True)
class Written:
    version: int
    rows: int
    again: bool = False  # it was complete already


def delta_available(spark: SparkSession) -> bool:
    try:
        import delta  # noqa: F401
    except ImportError:
        return False
    return "delta" in (spark.conf.get("spark.sql.extensions", "") or "").lower()


# --- folder listing -----------------------------------------------------------------

def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, location = _files(spark, path)
    if not fs.exists(location):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory())


def _writes(spark: SparkSession, path: str) -> list[str]:
    return [name for name in _folders(spark, path) if name.startswith("v=")]


def _number(name: str) -> int:
    return int(name[2:].split("-")[0])


def _complete(spark: SparkSession, path: str, name: str) -> Version | None:
    fs, marker = _files(spark, f"{path}/{name}/{SUCCESS}")
    if not fs.exists(marker):
        return None
    when = fs.getFileStatus(marker).getModificationTime()
    return Version(_number(name), name.split("-")[1] == "full", f"{path}/{name}", when)


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Complete writes, oldest first."""
    found = (_complete(spark, path, name) for name in _writes(spark, path))
    return [v for v in found if v is not None]


def _put_text(spark: SparkSession, path: str, text: str) -> None:
    fs, location = _files(spark, path)
    stream = fs.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _get_text(spark: SparkSession, path: str) -> str | None:
    fs, location = _files(spark, path)
    if not fs.exists(location):
        return None
    stream = fs.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folded(spark: SparkSession, full: Version) -> set[str]:
    """Names of the writes that a full one holds."""
    table, name = full.path.rsplit("/", 1)
    text = _get_text(spark, f"{table}/{FOLDED}/{name}")
    return set((text or "").split("\n")) - {""}


def in_force(spark: SparkSession, found: Sequence[Version], version: int | None = None) -> list[Version]:
    """The last full write and the parts that it does not hold; without one, all parts."""
    upto = [v for v in found if version is None or v.number <= version]
    full = [v for v in upto if v.full]
    if not full:
        return upto
    held = folded(spark, full[-1])
    return [full[-1], *[v for v in upto if not v.full and v.name not in held]]


# --- reading ------------------------------------------------------------------------

def read_table(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = (),
    order: Sequence[str] | None = None,
    version: int | None = None,
    deleted: bool = False,
    within: Collection[str] | None = None,
) -> DataFrame:
    """Current rows, or those of an earlier version; `deleted` shows deleted keys too.

    `within` names writes and leaves all others out: the state some reader saw before.
    """
    if delta_available(spark):
        reader = spark.read.format("delta")
        df = (reader.option("versionAsOf", version) if version is not None else reader).load(path)
    else:
        found = [v for v in versions(spark, path) if within is None or v.name in within]
        active = in_force(spark, found, version)
        if not active:
            raise FileNotFoundError(f"no complete version of {path}")
        df = _state(spark, active, keys, order)
    return df if deleted or DELETED not in df.columns else _live(df)


def exists(spark: SparkSession, path: str) -> bool:
    if delta_available(spark):
        from delta.tables import DeltaTable

        return DeltaTable.isDeltaTable(spark, path)
    return bool(versions(spark, path))


def _live(df: DataFrame) -> DataFrame:
    return df.where(~F.col(DELETED)).drop(DELETED)


def _state(
    spark: SparkSession,
    active: Sequence[Version],
    keys: Sequence[str],
    order: Sequence[str] | None,
    files: int | None = None,
) -> DataFrame:
    """The first write with the others on top; each holds a key once.

    Small parts take their keys' rows out of the first write, which does not move otherwise.
    With `files` the whole state is spread over so many partitions.
    """
    base, parts = spark.read.parquet(active[0].path), list(active[1:])
    if not parts:
        base = base.drop(*_bucket_columns(base))
        return base.repartition(files) if files else base
    if not keys:
        raise ValueError("a table with parts is read by its keys")
    merged = read_parts(spark, parts)
    alone = None
    buckets = _bucket_columns(base)
    if not files and len(buckets) == 1 and buckets == _bucket_columns(merged):
        # folder names tell which buckets the parts touch; the scan skips the others' files here
        touched = sorted(_buckets_of(spark, parts))
        alone = base.where(~F.col(buckets[0]).isin(touched)).drop(*buckets)
        base = base.where(F.col(buckets[0]).isin(touched))
    base, merged = base.drop(*buckets), merged.drop(*_bucket_columns(merged))
    if files or _bytes_of(spark, parts) * MOST_PARTS >= _bytes(spark, active[0].path):
        # most rows are compared or rewritten anyway: all move once, and are sorted only then
        rows = base.withColumn(_WRITE, F.lit("")).unionByName(merged, allowMissingColumns=True)
        spread = rows.repartition(files, *keys) if files else rows.repartition(*keys)
        state = top_n_by(spread, keys, _precedence(order), 1).drop(_WRITE)
        return state if alone is None else state.unionByName(alone, allowMissingColumns=True)
    changed = merged.select(*keys).distinct()
    untouched = base.join(changed, list(keys), "left_anti")
    contested = base.join(changed, list(keys), "left_semi").withColumn(_WRITE, F.lit(""))
    rows = contested.unionByName(merged, allowMissingColumns=True)
    newest = top_n_by(rows, keys, _precedence(order), 1).drop(_WRITE)
    state = untouched.unionByName(newest, allowMissingColumns=True)
    return state if alone is None else state.unionByName(alone, allowMissingColumns=True)


def _folded(
    spark: SparkSession,
    active: Sequence[Version],
    keys: Sequence[str],
    order: Sequence[str] | None,
    target_bytes: int | None,
) -> DataFrame:
    """The state in partitions of about `target_bytes`, for a write that folds the others in.

    Which write holds a key's current row is found on the keys and the order alone. Writes
    that others have replaced whole are not read further, and rows move only where a write
    has many of both kinds, current and replaced ones, or too few partitions for its files.
    """
    live, rows = list(active), None
    if len(active) > 1 and keys:
        every = _written(spark, active, active[0])
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*_precedence(order)))
        decided = every.select(*keys, _WRITE, (place == 1).alias("_won"))
        sums = decided.groupBy(_WRITE).agg(F.count(F.lit(1)).alias("n"), F.count_if("_won").alias("won"))
        groups = Groups.of(sums.collect(), _WRITE)
        named = {_name_of(v, active[0]): v for v in active}
        live = [v for name, v in named.items() if name in groups.live] or list(active[:1])
        if groups.live and not groups.many:
            marks = None
            if groups.few_old or groups.few_new:
                marks = cut_lineage(decided.where(groups.marked(_WRITE, "_won")), "marks")
            rows = groups.newest(lambda some: _written(spark, [named[n] for n in some], active[0]), marks, keys, _WRITE, "_won")
        shape = every.drop(_WRITE).schema
    files = target_bytes and max(1, math.ceil(_bytes_of(spark, live) / target_bytes))
    if rows is None:
        state = _state(spark, live, keys, order, files)
    elif not files:
        state = rows
    elif spark.read.parquet(*[v.path for v in live]).rdd.getNumPartitions() >= files:
        state = rows.coalesce(files)
    else:
        state = rows.repartition(files)
    if len(active) == 1 or not keys:
        return state
    # columns that only replaced writes have stay, and types that they have widened
    held = set(state.columns)
    return state.select([(F.col(f"`{f.name}`") if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])


def _name_of(v: Version, first: Version) -> str:
    """The name a write's rows are told apart by; the first one's comes before all others."""
    return "" if v == first else v.name.removeprefix("v=")


def _written(spark: SparkSession, some: Sequence[Version], first: Version) -> DataFrame:
    """All rows of some writes, each with the name of the write it came by."""
    frames = [spark.read.parquet(first.path).withColumn(_WRITE, F.lit(""))] if first in some else []
    later = [v for v in some if v != first]
    frames += [read_parts(spark, later)] if later else []
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.drop(*_bucket_columns(rows))


def _bucket_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name.startswith(_BUCKET)]


def _buckets_of(spark: SparkSession, parts: Sequence[Version]) -> set[int]:
    names = (name for v in parts for name in _folders(spark, v.path) if name.startswith(_BUCKET))
    return {int(name.split("=")[1]) for name in names}


def read_parts(spark: SparkSession, parts: Sequence[Version]) -> DataFrame:
    """All rows of some writes, each with the name of the write it came by.

    Parts of one schema are one scan; one footer of each part is read, not all of them.
    """
    groups: dict[str, list[str]] = {}
    columns: dict[str, list[str]] = {}
    for v in parts:
        df = spark.read.parquet(v.path)
        # folders below several roots are read from the table's folder, which adds the column v
        alone = v.path if _bucket_columns(df) and "v" in df.columns else ""
        kind = df.schema.json() + alone
        groups.setdefault(kind, []).append(v.path)
        columns[kind] = df.columns
    scans = []
    for kind, paths in groups.items():
        root = paths[0].rsplit("/", 1)[0]
        df = spark.read.option("basePath", root).parquet(*paths) if len(paths) > 1 else spark.read.parquet(*paths)
        name = F.regexp_extract("_metadata.file_path", r"/v=(\d+-part[^/]*)/", 1)
        scans.append(df.select(*columns[kind], name.alias(_WRITE)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _bytes_of(spark: SparkSession, parts: Sequence[Version]) -> int:
    return sum(_bytes(spark, v.path) for v in parts)


def _bytes(spark: SparkSession, path: str) -> int:
    fs, location = _files(spark, path)
    return fs.getContentSummary(location).getLength()


def _precedence(order: Sequence[str] | None) -> list[Column]:
    """Total, as no write holds a key twice: columns that a reader leaves out are not read for it."""
    if not order:  # the last write wins
        return [F.desc(_WRITE)]
    # the newer row wins, whenever it was written; a tie is a repeat of the same change or
    # the replay of a corrected load date, so the later write counts
    return [*[F.col(name).desc_nulls_last() for name in order], F.desc(_WRITE)]


# --- writing ------------------------------------------------------------------------

def upsert_table(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    ties: Sequence[str] = (),
    unique: bool = False,
    writer: str | None = None,
    buckets: int | None = None,
    newest: Callable[..., DataFrame] = latest_by,
) -> Written:
    """Merge rows into a table by key, or create it; batch and stream both end here.

    Repeated keys are first reduced to their `newest` row, unless the caller knows they are
    `unique`. With `order`, a row that is older than the stored one changes nothing, so a
    replayed or late batch is harmless; an equal one replaces it, so that a load date can be
    redone. A null key is an error. Rows marked `_deleted` delete.

    `writer` names the write: a retry under the same name takes the place of a try that
    failed, and is not written again after one that did not. All writes of a table have to
    agree on `buckets`; where they do not, reads compare keys without skipping any.
    """
    spark = df.sparkSession
    name = None
    if not delta_available(spark):
        name = _name(spark, path, "part", writer)
        done = _complete(spark, path, name)
        if done is not None:
            return Written(done.number, spark.read.parquet(done.path).count(), again=True)
    source = _with_keys(df, keys)
    if not unique:
        source = newest(source, keys, list(order or ()), ties)
    if name is None:
        return _upsert_delta(source, path, keys, order)
    return _write(source, path, name, keys=keys, buckets=buckets)


def replace_table(df: DataFrame, path: str) -> Written:
    """Write a whole new state beside the old one; readers see it once it is complete."""
    return _write_full(df, path, versions(df.sparkSession, path))


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The last complete state of a table that is always replaced whole."""
    full = [v for v in versions(spark, path) if v.full]
    if not full:
        raise FileNotFoundError(f"no complete version of {path}")
    return spark.read.parquet(full[-1].path)


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    checked = {
        k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null key {k}"))).otherwise(F.col(k)) for k in keys
    }
    return df.withColumns(checked)


def _name(spark: SparkSession, path: str, kind: str, writer: str | None = None) -> str:
    """A folder of the next number, or the one that this writer has begun before."""
    taken = _writes(spark, path)
    own = re.sub(r"[^A-Za-z0-9_.]", "_", writer) if writer else uuid.uuid4().hex[:16]
    for name in taken:
        if name.endswith(f"-{kind}-{own}"):
            return name
    number = max(map(_number, taken), default=0) + 1
    return f"v={number:08d}-{kind}-{own}"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key; by its text, so that an int and a long of one value agree."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _write(
    df: DataFrame,
    path: str,
    name: str,
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> Written:
    seen = Observation()
    folders: list[str] = []
    if buckets:
        if not 0 < buckets <= MOST_BUCKETS:
            raise ValueError(f"between 1 and {MOST_BUCKETS} buckets, not {buckets}")
        folders = [f"{_BUCKET}{buckets}"]
        # even files: small buckets share a task, a large one is split
        df = df.withColumn(folders[0], bucket_of(keys, buckets)).hint("rebalance", folders[0])
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.partitionBy(*folders).mode("overwrite").parquet(f"{path}/{name}")
    return Written(_number(name), seen.get["rows"])


def _write_full(df: DataFrame, path: str, held: Sequence[Version], **more) -> Written:
    """A whole state in place of the writes `held`, which are noted down before it counts."""
    spark = df.sparkSession
    name = _name(spark, path, "full")
    _put_text(spark, f"{path}/{FOLDED}/{name}", "\n".join(v.name for v in held))
    return _write(df, path, name, **more)


def _upsert_delta(source: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] | None) -> Written:
    from delta.tables import DeltaTable

    spark = source.sparkSession
    seen = Observation()
    source = source.observe(seen, F.count(F.lit(1)).alias("rows"))
    if not DeltaTable.isDeltaTable(spark, path):
        source.write.format("delta").mode("overwrite").save(path)
    else:
        same_key = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
        newer = None
        if order:
            left = ", ".join(f"s.`{c}`" for c in order)
            right = ", ".join(f"t.`{c}`" for c in order)
            newer = f"struct({left}) >= struct({right})"
        table = DeltaTable.forPath(spark, path)
        merge = table.alias("t").merge(source.alias("s"), same_key)
        merge.whenMatchedUpdateAll(condition=newer).whenNotMatchedInsertAll().execute()
    log = DeltaTable.forPath(spark, path).history(1).select("version").first()
    return Written(log["version"], seen.get["rows"])


# --- groups of rows -------------------------------------------------------------------

def replace_groups(
    df: DataFrame, touched: DataFrame, path: str, keys: Sequence[str], note: str = ""
) -> Written:
    """Replace all rows of the `touched` keys by those in df, which may be none or several.

    `note` is kept with the write, for whoever goes on from here.
    """
    spark = df.sparkSession
    marks = touched.select(*keys).distinct().withColumn(DELETED, F.lit(True))
    rows = df.withColumn(DELETED, F.lit(False)).unionByName(marks, allowMissingColumns=True)
    name = _name(spark, path, "part")
    _put_text(spark, f"{path}/_notes/{name}", note)
    return _write(rows, path, name)


def replace_all_groups(df: DataFrame, path: str, note: str = "") -> Written:
    """A whole new state of such a table."""
    spark = df.sparkSession
    name = _name(spark, path, "full")
    _put_text(spark, f"{path}/{FOLDED}/{name}", "\n".join(v.name for v in versions(spark, path)))
    _put_text(spark, f"{path}/_notes/{name}", note)
    return _write(df, path, name)


def renote(spark: SparkSession, path: str, note: str) -> None:
    """Give the last complete write another note."""
    _put_text(spark, f"{path}/_notes/{versions(spark, path)[-1].name}", note)


def compact_groups(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Fold the replaced groups into one full write, which keeps the last note."""
    if len(in_force(spark, versions(spark, path))) > 1:
        replace_all_groups(read_groups(spark, path, keys), path, last_note(spark, path) or "")


def last_note(spark: SparkSession, path: str) -> str | None:
    """The note of the last complete write."""
    found = versions(spark, path)
    return _get_text(spark, f"{path}/_notes/{found[-1].name}") if found else None


def read_groups(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current rows: those of a key's last write, if any of it says something about the key."""
    active = in_force(spark, versions(spark, path))
    if not active or not active[0].full:
        raise FileNotFoundError(f"no complete version of {path}")
    base = spark.read.parquet(active[0].path)
    if len(active) == 1:
        return base
    parts = read_parts(spark, active[1:])
    last = parts.groupBy(*keys).agg(F.max(_WRITE).alias(_WRITE))
    rows = _live(parts.join(last, [*keys, _WRITE], "left_semi")).drop(_WRITE)
    untouched = base.join(last.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(rows).select(base.columns)


# --- maintenance --------------------------------------------------------------------

def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = (),
    order: Sequence[str] | None = None,
    target_bytes: int = TARGET_BYTES,
    forget_deleted: bool = False,
    buckets: int | None = None,
) -> int:
    """Fold all complete parts into one full write with files of about `target_bytes`.

    Writes that run meanwhile, or failed, do not matter: what is not named as folded is
    read on top. Deleted keys stay marked, so that a late older row cannot bring one back,
    until a compaction is told to forget them.
    """
    if delta_available(spark):
        from delta.tables import DeltaTable

        DeltaTable.forPath(spark, path).optimize().executeCompaction()
        return DeltaTable.forPath(spark, path).history(1).select("version").first()["version"]
    found = versions(spark, path)
    active = in_force(spark, found)
    state = _folded(spark, active, keys, order, None if buckets else target_bytes)
    if forget_deleted and DELETED in state.columns:
        state = state.where(~F.col(DELETED))
    return _write_full(state, path, found, keys=keys, buckets=buckets).version


def vacuum(
    spark: SparkSession, path: str, hours: float = RETENTION_HOURS, now_ms: int | None = None
) -> list[int]:
    """Remove versions that no read within the retention period needs; returns their numbers.

    What is in force now, and what a time-travel read inside the period builds on, stays.
    What a failed write has left goes too once it is older than the period.
    """
    if delta_available(spark):
        from delta.tables import DeltaTable

        DeltaTable.forPath(spark, path).vacuum(hours)
        return []
    found = versions(spark, path)
    limit = (now_ms or int(time.time() * 1000)) - int(hours * 3600 * 1000)
    visible = [v.number for v in found if v.committed_ms >= limit]
    # the state that was current when the period began is still readable within it
    before = [v.number for v in found if v.committed_ms < limit]
    oldest = before[-1] if before else (visible[0] if visible else None)
    needed = {v.name for v in in_force(spark, found)}
    for number in [*([oldest] if oldest is not None else []), *visible]:
        needed.update(v.name for v in in_force(spark, found, number))
    complete = {v.name for v in found}
    removed = []
    for name in _writes(spark, path):
        fs, location = _files(spark, f"{path}/{name}")
        if name in needed or name not in complete and fs.getFileStatus(location).getModificationTime() >= limit:
            continue
        fs.delete(location, True)
        removed.append(_number(name))
    return removed
