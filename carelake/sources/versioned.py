"""A keyed table as versions of immutable parquet segments.

Layout::

    <table>/seg=<name>/part-*.parquet   rows of one commit, never changed afterwards
    <table>/_index/<name>               per file of the segment: rows, key range, cluster range
    <table>/_log/<version>              what is live in a version, and what the commit changed
    <table>/_leases/<id>                versions that long readers hold

A commit writes a *delta* segment (the batch's winning rows only) and then its
log entry, which is created under its number only if nobody else has done so.
A writer that finds the number taken starts again from the newer version, so
two writers never lose each other's rows.  A reader is bound to the version it
opened: later commits, compaction and retention do not touch its files.

Each row carries ``_load_seq``, the number of the load that wrote it.  A batch
row wins over the stored row of its key only if that has a smaller number, so
loads may be finished or replayed in any order and the latest load stays; a
batch that is already in changes nothing.  The delta keeps, next to each row,
the row it replaced (``_old``): the change set for downstream aggregates,
exact for the version that it was committed on.

Reading merges on key: base files that no delta touches are scanned plainly;
only the touched ones meet the keys of the deltas.  ``compact`` rewrites the
touched files and the deltas as base files in cluster order (date, department),
and leaves all others where they are.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from carelake.sources.sinks import _fs, delete, list_names, publish_text, read_text, write_text

SEQ = "_load_seq"
CLEANED = "_cleaned_at"
#: Commits that lose the race for a version number start again as often as this.
ATTEMPTS = 20
#: Cells that the key span of a batch is divided into to find the files that may hold its keys.
CELLS = 1024
#: Versions that retention keeps.
KEEP_VERSIONS = 10
#: Seconds that a lease lasts unless it is given up.
LEASE_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Table:
    """A table's place, its key, and the columns its base files are ordered by."""

    path: str
    key: str
    cluster: tuple[str, ...] = ()


# -------------------------------------------------------------------- log
def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in list_names(spark, f"{path}/_log") if n.isdigit())


def entry(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The log entry of a version (default: the newest); None where the table has none."""
    if version is None:
        found = versions(spark, path)
        if not found:
            return None
        version = found[-1]
    text = read_text(spark, f"{path}/_log/{version:012d}")
    return None if text is None else json.loads(text)


def _commit(spark: SparkSession, path: str, new: dict) -> bool:
    return publish_text(spark, f"{path}/_log/{new['version']:012d}", json.dumps(new))


# ------------------------------------------------------------------ files
def _index(spark: SparkSession, path: str, segment: str) -> list[dict]:
    text = read_text(spark, f"{path}/_index/{segment}")
    if text is None:
        raise FileNotFoundError(f"no index of segment {segment} of {path}")
    return json.loads(text)


def _write_index(spark: SparkSession, table: Table, segment: str, schema: StructType) -> list[dict]:
    """Rows, key range and cluster range of each file, from a scan of those two columns."""
    lead = table.cluster[0] if table.cluster else table.key
    rows = spark.read.schema(schema).parquet(f"{table.path}/seg={segment}")
    stats = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"),
        F.min(table.key).alias("key_lo"), F.max(table.key).alias("key_hi"),
        F.min(lead).cast("string").alias("lo"), F.max(lead).cast("string").alias("hi"),
        F.max("_metadata.file_size").alias("bytes"),
    )
    files = sorted((r.asDict() for r in stats.collect()), key=lambda f: f["file"])
    write_text(spark, f"{table.path}/_index/{segment}", json.dumps(files))
    return files


def _drop(spark: SparkSession, path: str, segment: str) -> None:
    delete(spark, f"{path}/seg={segment}")
    delete(spark, f"{path}/_index/{segment}")


def live_files(spark: SparkSession, path: str, state: dict) -> list[dict]:
    """Every live base file of a version, with its segment."""
    out = []
    for s in state["base"]:
        gone = set(s["dropped"])
        out += [f | {"segment": s["name"]} for f in _index(spark, path, s["name"]) if f["file"] not in gone]
    return out


def _scan(spark: SparkSession, path: str, schema: StructType, files: list[dict]) -> DataFrame:
    names = [f"{path}/seg={f['segment']}/{f['file']}" for f in files]
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def _row_schema(state: dict) -> StructType:
    return StructType.fromJson(json.loads(state["schema"]))


# ------------------------------------------------------------------- read
def read(spark: SparkSession, table: Table, version: int | None = None, between: tuple | None = None,
         days: Sequence | None = None) -> DataFrame | None:
    """The rows of a version (default: the newest), bound to it; None where the table has none.

    ``between`` = (first, last) dates of the leading cluster column, or ``days`` = some of its dates: base files without
    such a date are not opened, and other rows do not come.
    """
    state = entry(spark, table.path, version)
    return None if state is None else _merged(spark, table, state, between, days)


def _merged(spark: SparkSession, table: Table, state: dict, between: tuple | None = None, days: Sequence | None = None) -> DataFrame:
    schema = _row_schema(state)
    files = live_files(spark, table.path, state)
    spans = [] if between is None else [tuple(map(str, between))]
    spans += [(str(d), str(d)) for d in sorted(days or ())]
    if between is not None or days is not None:
        files = [f for f in files if f["hi"] is not None and any(a <= f["hi"] and f["lo"] <= b for a, b in spans)]
    touched = {tuple(x) for x in state["touched"]}
    plain = [f for f in files if (f["segment"], f["file"]) not in touched]
    mixed = [f for f in files if (f["segment"], f["file"]) in touched]
    out = _scan(spark, table.path, schema, plain)
    if state["deltas"]:
        latest = _latest(spark, table, state)
        if mixed:
            keys = latest.select(F.col(table.key).alias("_replaced"))
            rest = _scan(spark, table.path, schema, mixed)
            out = out.unionByName(rest.join(keys, F.col(table.key) == F.col("_replaced"), "left_anti"))
        out = out.unionByName(latest) if plain or mixed else latest
    lead = F.col(table.cluster[0] if table.cluster else table.key)
    if between is not None:
        out = out.filter(lead.between(*[F.lit(d).cast("date") for d in spans[0]]))
    if days is not None:
        out = out.filter(lead.cast("string").isin([a for a, _ in spans]))
    return out


def _latest(spark: SparkSession, table: Table, state: dict) -> DataFrame:
    """Newest delta row of each key."""
    schema = _row_schema(state)
    names = [f"{table.path}/seg={d}" for d in state["deltas"]]
    rows = spark.read.schema(schema).parquet(*names)
    if len(names) == 1:
        return rows
    best = rows.groupBy(table.key).agg(F.max_by(F.struct(*schema.names), SEQ).alias("_row"))
    return best.select(*[F.col(f"_row.{c}").alias(c) for c in schema.names])


def holding(spark: SparkSession, table: Table, state: dict, keys: DataFrame) -> set[tuple[str, str]]:
    """Base files (segment, file) whose key range meets a part of the key span that ``keys`` occupies.

    The span is divided into CELLS parts; the driver sees the occupied ones (CELLS numbers at most), so a single odd id
    does not open every file."""
    span = keys.agg(F.min(table.key), F.max(table.key)).first()
    if span[0] is None:
        return set()
    width = max(1, -(-(span[1] - span[0] + 1) // CELLS))
    cell = F.expr(f"(`{table.key}` - {span[0]}) div {width}")
    cells = sorted(r[0] for r in keys.select(cell.alias("c")).distinct().collect())
    ranges = [(span[0] + c * width, span[0] + (c + 1) * width - 1) for c in cells]
    out, at = set(), 0
    for f in sorted(live_files(spark, table.path, state), key=lambda f: f["key_lo"]):
        while at < len(ranges) and ranges[at][1] < f["key_lo"]:
            at += 1
        if any(lo <= f["key_hi"] for lo, _ in ranges[at : at + 1]):
            out.add((f["segment"], f["file"]))
    return out


# ------------------------------------------------------------------ write
def clustered(df: DataFrame, table: Table) -> DataFrame:
    """Rows in cluster order.  No number of partitions is given, so adaptive execution sizes them by the data; the key
    comes last, so a day that holds a third of all rows is divided too."""
    order = [*table.cluster, table.key]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def merge(spark: SparkSession, table: Table, batch: DataFrame, seq: int) -> int | None:
    """Commit ``batch`` (one row per key) as load number ``seq``; returns the version that holds it.

    None where there is neither a table nor a row.  ``batch`` should be stored rows: it is read again for every attempt.
    """
    path = table.path
    rows = batch.withColumn(SEQ, F.lit(seq).cast("bigint"))
    for _ in range(ATTEMPTS):
        state = entry(spark, path)
        name = f"{seq}-{uuid.uuid4().hex[:12]}"
        place = f"{path}/seg={name}"
        if state is None:
            first = rows.withColumn(CLEANED, F.localtimestamp())
            clustered(first, table).write.parquet(place)
            files = _write_index(spark, table, name, first.schema)
            if not files:
                _drop(spark, path, name)
                return None
            new = {"version": 0, "schema": first.schema.json(), "base": [{"name": name, "dropped": []}], "deltas": [],
                   "touched": []}
        else:
            schema = _row_schema(state)
            o, b = _stored(spark, table, state, batch.select(table.key)).alias("o"), rows.alias("b")
            kept = F.struct(*[F.col(f"o.`{c}`").alias(c) for c in schema.names])
            there = F.col(f"o.`{table.key}`").isNotNull()
            won = b.join(o, F.col(f"b.`{table.key}`") == F.col(f"o.`{table.key}`"), "left").filter(
                ~there | (F.col(f"o.{SEQ}") < F.lit(seq)))
            delta = won.select(
                *[F.coalesce(F.col(f"o.{CLEANED}"), F.localtimestamp()).alias(c) if c == CLEANED
                  else F.col(f"b.`{c}`").alias(c) for c in schema.names],
                F.when(there, kept).alias("_old"), F.col("o._file").alias("_old_file"))
            delta.write.parquet(place)
            files = _write_index(spark, table, name, schema)
            if not files:
                _drop(spark, path, name)
                return state["version"]
            replaced = spark.read.parquet(place).filter("_old_file is not null").select("_old_file").distinct().collect()
            base = {s["name"] for s in state["base"]}
            hit = {tuple(r[0].rsplit("/seg=", 1)[1].split("/", 1)) for r in replaced}
            touched = {tuple(t) for t in state["touched"]} | {t for t in hit if t[0] in base}
            new = state | {"version": state["version"] + 1, "deltas": [*state["deltas"], name], "touched": sorted(touched)}
        new |= {"kind": "merge", "segment": name, "load": seq, "rows": sum(f["rows"] for f in files), "at": time.time()}
        if _commit(spark, path, new):
            return new["version"]
        # Another writer took the number: what it changed decides anew which rows win.
        _drop(spark, path, name)
    raise RuntimeError(f"{path}: {ATTEMPTS} other commits came first")


def _stored(spark: SparkSession, table: Table, state: dict, keys: DataFrame) -> DataFrame:
    """The current rows of ``keys``, each with the file it lies in (``_file``); only files that may hold one are opened."""
    schema = _row_schema(state)
    only = holding(spark, table, state, keys)
    files = [f for f in live_files(spark, table.path, state) if (f["segment"], f["file"]) in only]
    wanted = keys.select(F.col(table.key).alias("_wanted"))
    paths = [f"{table.path}/seg={f['segment']}/{f['file']}" for f in files] + [f"{table.path}/seg={d}" for d in state["deltas"]]
    rows = spark.read.schema(schema).parquet(*paths).withColumn("_file", F.col("_metadata.file_path"))
    rows = rows.join(wanted, F.col(table.key) == F.col("_wanted"), "left_semi")
    best = rows.groupBy(table.key).agg(F.max_by(F.struct(*schema.names, "_file"), SEQ).alias("_row"))
    return best.select(*[F.col(f"_row.{c}").alias(c) for c in [*schema.names, "_file"]])


def rows_of(spark: SparkSession, table: Table, version: int, keys: DataFrame) -> DataFrame:
    """The rows of some keys (a column named as the table's key) in a version, from the files that may hold them."""
    return _stored(spark, table, entry(spark, table.path, version), keys).drop("_file")


def compact(spark: SparkSession, table: Table) -> int | None:
    """Rewrite the deltas and the base files they touch as base files in cluster order; returns the new version.

    Files that no delta touches stay.  If a writer commits meanwhile, its delta stays on top: the rows that were
    compacted are older than its own, so the entry is made again with the newer deltas kept.
    """
    path = table.path
    state = entry(spark, path)
    if state is None or not state["deltas"]:
        return None if state is None else state["version"]
    schema = _row_schema(state)
    touched = {tuple(t) for t in state["touched"]}
    name = f"c{state['version']}-{uuid.uuid4().hex[:12]}"
    rows = _latest(spark, table, state)
    if touched:
        rest = _scan(spark, path, schema, [{"segment": s, "file": f} for s, f in sorted(touched)])
        keys = rows.select(F.col(table.key).alias("_replaced"))
        rows = rest.join(keys, F.col(table.key) == F.col("_replaced"), "left_anti").unionByName(rows)
    clustered(rows, table).write.parquet(f"{path}/seg={name}")
    _write_index(spark, table, name, schema)
    done, base_names = set(state["deltas"]), {s["name"] for s in state["base"]}
    for _ in range(ATTEMPTS):
        now = entry(spark, path)
        if {s["name"] for s in now["base"]} != base_names or not done <= set(now["deltas"]):
            break  # another compaction came first
        base = [{"name": s["name"], "dropped": sorted({*s["dropped"], *(f for n, f in touched if n == s["name"])})} for s in now["base"]]
        base = [s for s in base if len(s["dropped"]) < len(_index(spark, path, s["name"]))]
        later = [d for d in now["deltas"] if d not in done]
        still = _still_touched(spark, table, now, later, touched, name) if later else []
        new = now | {"version": now["version"] + 1, "kind": "compact", "segment": None, "load": None, "at": time.time(),
                     "base": [*base, {"name": name, "dropped": []}], "deltas": later, "touched": still}
        if _commit(spark, path, new):
            return new["version"]
    _drop(spark, path, name)
    return entry(spark, path)["version"]


def _still_touched(spark: SparkSession, table: Table, now: dict, later: list[str], gone: set, made: str) -> list:
    """Files that deltas committed during a compaction replace rows of: those noted, and all of the new segment."""
    noted = {tuple(t) for t in now["touched"]} - gone
    return sorted(noted | {(made, f["file"]) for f in _index(spark, table.path, made)})


# ---------------------------------------------------------------- changes
def changes(spark: SparkSession, table: Table, after: int, upto: int) -> tuple[DataFrame, DataFrame] | None:
    """(new rows, rows they replaced) of the commits after version ``after`` up to ``upto``; None if retention has taken
    one of them (what depends on them is then rebuilt).  A row that several commits replaced comes once for each."""
    new, old = None, None
    for v in range(after + 1, upto + 1):
        e = entry(spark, table.path, v)
        if e is None:
            return None
        if e["kind"] != "merge":
            continue
        schema = _row_schema(e)
        place = f"{table.path}/seg={e['segment']}"
        if read_text(spark, f"{table.path}/_index/{e['segment']}") is None:
            return None
        rows = spark.read.schema(schema).parquet(place)
        if v == 0:
            gone = spark.createDataFrame([], schema)
        else:
            both = spark.read.schema(StructType([*schema.fields, StructField("_old", schema)])).parquet(place)
            gone = both.filter("_old is not null").select("_old.*")
        new, old = (rows, gone) if new is None else (new.unionByName(rows), old.unionByName(gone))
    if new is None:
        schema = _row_schema(entry(spark, table.path, upto))
        new = old = spark.createDataFrame([], schema)
    return new, old


# -------------------------------------------------------------- retention
@contextmanager
def lease(spark: SparkSession, path: str, version: int, seconds: float = LEASE_SECONDS):
    """Hold a version's files against :func:`vacuum` while a long reader uses them."""
    name = f"{path}/_leases/{uuid.uuid4().hex}"
    write_text(spark, name, json.dumps({"version": version, "until": time.time() + seconds}))
    try:
        yield version
    finally:
        delete(spark, name)


def vacuum(spark: SparkSession, path: str, keep: int = KEEP_VERSIONS, grace: float = 3600.0) -> int:
    """Delete what no kept version needs; returns the number of segments deleted.

    Kept are the newest ``keep`` versions and those under a lease that has not run out.  A segment that no entry names
    may belong to a commit under way: it goes once it is older than ``grace`` seconds.
    """
    found = versions(spark, path)
    if not found:
        return 0
    held = set(found[-max(1, keep):])
    for n in list_names(spark, f"{path}/_leases"):
        text = read_text(spark, f"{path}/_leases/{n}")
        if text is None:
            continue
        if (x := json.loads(text))["until"] < time.time():
            delete(spark, f"{path}/_leases/{n}")
        else:
            held.add(x["version"])
    needed, known = set(), set()
    for v in found:
        e = entry(spark, path, v)
        if e is None:
            continue
        names = {s["name"] for s in e["base"]} | set(e["deltas"]) | ({e["segment"]} if e["segment"] else set())
        known |= names
        if v in held:
            needed |= names
    gone = 0
    fs, p = _fs(spark, path)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not name.startswith("seg=") or (name := name[4:]) in needed:
            continue
        if name in known or time.time() - st.getModificationTime() / 1000 > grace:
            _drop(spark, path, name)
            gone += 1
    for v in found:
        if v not in held:
            delete(spark, f"{path}/_log/{v:012d}")
    return gone


def bytes_of(spark: SparkSession, path: str, segments: Sequence[str]) -> int:
    """Bytes of the files of some segments."""
    return sum(f["bytes"] for s in segments for f in _index(spark, path, s))
