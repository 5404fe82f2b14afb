"""Config-driven layer runs: landing -> bronze -> silver -> gold, with one audit row per table.

Each table of a layer is one lazy plan and one write action; row counts come from
``DataFrame.observe`` on that write, so auditing adds no extra job.
"""

from __future__ import annotations

import datetime as _dt
import functools
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.dates import to_day, to_stamp
from lakeload.functions.text import remove_accents
from lakeload.operators._joins import max_frame, max_value, no_null_keys, translate_errors, unique_rows
from lakeload.operators.facts import UNKNOWN_SK, DimLookup, check_versions, load_fact
from lakeload.operators.prepare import add_load_date, prepare_silver, rename_keys
from lakeload.operators.scd1 import scd1_create, scd1_merge
from lakeload.operators.scd2 import IGNORE, is_open_version, scd2_change, scd2_create, with_new_columns
from lakeload.operators.snapshots import CHANGE_COL, snapshot_diff
from lakeload.operators.validate import DuplicateKeyError, first_per_key, not_unique, validate_keys
from lakeload.plans.layout import Layout
from lakeload.plans.roles import HASH_COL, LOAD_DATE_COL, OPEN_END, UPDATED_COL, key_columns, scd_type, sk_column, sk_name_for
from lakeload.sources.config import BRONZE_SCHEMA, CSV_SCHEMA, GOLD_SCHEMA, config_records, read_config
from lakeload.sources.files import (
    append_silver,
    load_is_empty,
    load_is_ordered,
    mark_empty_load,
    read_csv,
    read_latest_snapshot,
    read_load,
    publish_load,
    read_silver,
    silver_loads,
    snapshot_days,
    stage_load,
    stage_ordered_load,
    unconverted,
    typed_copy,
    write_snapshot,
)
from lakeload.sources.fs import delete_path, path_exists, touch
from lakeload.sources.store import (
    append_closed,
    closed_folder,
    current_version,
    current_version_path,
    last_load,
    materialize,
    observed,
    prune_versions,
    read_closed,
    read_own_rows,
    read_table,
    scratch_scope,
    table_exists,
    write_table,
)

# Our silver configuration object (one per table); replaces one hand-written loader per table.
SILVER_SPEC_SCHEMA = (
    "table_name string, source_path string, source_name string, keys array<string>, "
    "key_names map<string,string>, accent_keys map<string,string>, columns array<string>, "
    "distinct boolean, dedupe boolean, types map<string,string>, first_per_key boolean"
)
AUDIT_SCHEMA = (
    "run_date string, layer string, table_name string, status string, rows_in bigint, rows_out bigint, "
    "inserted bigint, closed bigint, n_open bigint, message string, started timestamp, finished timestamp"
)


@dataclass(frozen=True)
class SilverSpec:
    table_name: str
    source_path: str
    source_name: str
    keys: Sequence[str] = ()
    key_names: Mapping[str, str] = field(default_factory=dict)
    accent_keys: Mapping[str, str] = field(default_factory=dict)
    columns: Sequence[str] | None = None
    distinct: bool = False
    dedupe: bool = False
    types: Mapping[str, str] = field(default_factory=dict)
    first_per_key: bool = False  # keep one row of each key (the smallest by value) instead of failing

    @classmethod
    def from_record(cls, r: Mapping) -> SilverSpec:
        return cls(
            table_name=r["table_name"],
            source_path=r["source_path"],
            source_name=r["source_name"],
            keys=tuple(r.get("keys") or ()),
            key_names=dict(r.get("key_names") or {}),
            accent_keys=dict(r.get("accent_keys") or {}),
            columns=list(r["columns"]) if r.get("columns") else None,
            distinct=bool(r.get("distinct") or False),
            dedupe=bool(r.get("dedupe") or False),
            types=dict(r.get("types") or {}),
            first_per_key=bool(r.get("first_per_key") or False),
        )


def _audit(run_date, layer, table, status, started, rows_in=None, rows_out=None, inserted=None, closed=None,
           n_open=None, message=None) -> dict:
    return {
        "run_date": to_day(run_date), "layer": layer, "table_name": table, "status": status,
        "rows_in": rows_in, "rows_out": rows_out, "inserted": inserted, "closed": closed, "n_open": n_open,
        "message": message, "started": started, "finished": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
    }


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _describe(spark: SparkSession, text: str | None) -> None:
    """Label the Spark jobs of the current thread (shown in event logs and monitoring)."""
    try:
        spark.sparkContext.setJobDescription(text)
    except Exception:  # no SparkContext access (remote session)
        pass


def _each_table(
    items: Sequence, work: Callable, parallelism: int | None, spark: SparkSession | None = None,
    label: Callable[[object], str] | None = None, log: list[dict] | None = None,
    failed: Callable[[object, str], dict] | None = None,
) -> list:
    """Run ``work`` per table; up to ``parallelism`` tables at once (concurrent Spark jobs from driver
    threads, like a parallel for-each). Results keep the config order; any failure fails the layer
    after the running tables have finished. ``log`` gets the audit row of every table, failed ones too."""
    items = list(items)
    if log is not None:
        rows = {}
        logged = work

        def work(x):  # noqa: F811 - notes the outcome
            try:
                rows[id(x)] = logged(x)
            except Exception as e:
                rows[id(x)] = failed(x, f"{type(e).__name__}: {e}"[:2000])
                raise
            return rows[id(x)]

        try:
            return _each_table(items, work, parallelism, spark, label)
        finally:
            log += [rows[id(x)] for x in items if id(x) in rows]
    if spark is not None and label is not None:
        inner = work

        def work(x):  # noqa: F811 - labelled wrapper
            _describe(spark, f"lakeload {label(x)}")
            try:
                return inner(x)
            finally:
                _describe(spark, None)

    n = min(len(items), parallelism or 8)
    if n <= 1:
        return [work(x) for x in items]
    with ThreadPoolExecutor(max_workers=n, thread_name_prefix="lakeload-table") as pool:
        futures = [pool.submit(work, x) for x in items]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e
    return [f.result() for f in futures]


# ---------------------------------------------------------------- bronze
_CSV_OPTIONS = ("sep", "quote", "escape", "multi_line", "encoding")
MALFORMED = "_malformed_record"


def run_bronze(
    spark: SparkSession, layout: Layout, entries: Iterable[Mapping], run_date, parallelism: int | None = None,
    log: list[dict] | None = None,
) -> list[dict]:
    """Copy each landing CSV to ``bronze/<target_path>/<yyyy-MM-dd>/<target_name>`` (all strings).

    An entry may carry CSV options (``sep``, ``quote``, ``escape``, ``multi_line``, ``encoding``). Records with more
    or fewer fields than the header are counted in the audit message; ``on_malformed`` ``"fail"`` fails the table,
    ``"keep"`` stores them whole in one more column."""

    def one(e: Mapping) -> dict:
        started = _now()
        options = {k: e[k] for k in _CSV_OPTIONS if e.get(k) is not None}
        df = read_csv(spark, layout.landing(e["source_path"], e["source_name"]), malformed=MALFORMED, **options)
        obs = Observation(f"bronze_{e['target_name']}")
        bad = F.col(MALFORMED).isNotNull()
        if e.get("on_malformed") == "fail":
            stop = F.raise_error(F.concat(F.lit("malformed record: "), F.col(MALFORMED)))
            df = df.withColumn(MALFORMED, F.when(bad, stop).otherwise(F.col(MALFORMED)))
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(bad.cast("long")).alias("bad"))
        if e.get("on_malformed") != "keep":
            df = df.drop(MALFORMED)
        write_snapshot(df, layout.bronze(e["target_path"]), run_date, e["target_name"])
        n, k = observed(obs).get("rows") or 0, observed(obs).get("bad") or 0
        return _audit(run_date, "bronze", e["target_name"], "ok", started, rows_in=n, rows_out=n,
                      message=f"{k} malformed records" if k else None)

    return _each_table(
        entries, one, parallelism, spark, lambda e: f"bronze {e['target_name']} {to_day(run_date)}", log,
        lambda e, m: _audit(run_date, "bronze", e["target_name"], "failed", _now(), message=m),
    )


# ---------------------------------------------------------------- silver
def silver_frame(
    spark: SparkSession, layout: Layout, spec: SilverSpec, run_date, seen: Observation | None = None, by_range: bool = False
) -> DataFrame:
    """Newest bronze snapshot up to the run date -> typed -> keys marked -> stamped -> hashed; keys are not checked.

    ``seen`` observes the rows read and the values that did not convert. ``by_range``: the first rows per key in key order."""
    df = read_latest_snapshot(spark, layout.bronze(spec.source_path), spec.source_name, to_day(run_date))
    if seen is not None:
        df = df.observe(seen, *_read_counts(df, spec))
    df = typed_copy(df, spec.types or None)
    if spec.accent_keys:
        df = df.withColumns({new: remove_accents(F.col(src)) for src, new in spec.accent_keys.items()})
    if spec.key_names:
        df = rename_keys(df, spec.key_names)
    elif spec.keys:
        df = rename_keys(df, list(spec.keys))
    df = add_load_date(df, run_date)
    if spec.columns:
        cols = list(spec.columns) + ([] if "LoadDate" in spec.columns else ["LoadDate"])
        df = df.select(*cols)
    if spec.first_per_key:  # the keys are unique then: nothing to check
        keys = key_columns(df.columns)
        by_range = by_range and bool(keys)
        df = prepare_silver(first_per_key(df, keys, by_range=by_range), validate=False)
        return df.sortWithinPartitions(*keys) if by_range else df
    if spec.distinct or spec.dedupe:
        df = df.distinct() if spec.distinct else df.dropDuplicates([c for c in df.columns if c != LOAD_DATE_COL])
    return prepare_silver(df, validate=False)


def _read_counts(df: DataFrame, spec: SilverSpec) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), unconverted(df, spec.types).alias("lost")]


def check_load(staged: DataFrame) -> None:
    """Raise unless each key of a staged load has one row, by its keys and row fingerprint alone."""
    keys = key_columns(staged.columns)
    if keys and not validate_keys(staged.select(*keys, HASH_COL)).valid:
        raise DuplicateKeyError(not_unique(keys))


def run_silver(
    spark: SparkSession, layout: Layout, specs: Iterable[SilverSpec], run_date, parallelism: int | None = None,
    log: list[dict] | None = None,
) -> list[dict]:
    """One load per table: staged, checked, published. The rows are computed and written once, in a folder beside the
    table; the check reads keys and fingerprint of what was written. A load that passes takes the place of an earlier
    run of its day by renaming; one that fails leaves no trace. A load without rows is marked as such. The first rows per
    key are written in key order, so that gold numbers them where they lie."""

    def one(spec: SilverSpec) -> dict:
        started = _now()
        seen, obs = Observation(f"read_{spec.table_name}"), Observation(f"silver_{spec.table_name}")
        path, rows = layout.silver(spec.table_name), F.count(F.lit(1)).alias("rows")
        if spec.first_per_key:  # ranges are sampled, which would observe the rows read once more
            staging = stage_ordered_load(silver_frame(spark, layout, spec, run_date, by_range=True).observe(obs, rows), path, to_day(run_date))
        else:
            staging = stage_load(silver_frame(spark, layout, spec, run_date, seen).observe(obs, rows), path)
        try:
            n = observed(obs).get("rows") or 0
            if spec.first_per_key:
                df = read_latest_snapshot(spark, layout.bronze(spec.source_path), spec.source_name, to_day(run_date))
                read = df.agg(*_read_counts(df, spec)).first().asDict()
            else:
                read = observed(seen)
            if n and not spec.first_per_key:
                check_load(spark.read.parquet(staging))
            publish_load(spark, staging, path)
        finally:
            delete_path(spark, staging)
        lost = read.get("lost")
        if not n:
            mark_empty_load(spark, path, to_day(run_date))
        return _audit(run_date, "silver", spec.table_name, "ok", started, rows_in=read.get("rows") or 0, rows_out=n,
                      message=f"{lost} values did not convert" if lost else None)

    return _each_table(
        specs, one, parallelism, spark, lambda x: f"silver {x.table_name} {to_day(run_date)}", log,
        lambda x, m: _audit(run_date, "silver", x.table_name, "failed", _now(), message=m),
    )


def run_difference(spark: SparkSession, layout: Layout, spec: SilverSpec, run_date) -> dict:
    """The load of a day as a difference feed: what its bronze snapshot changed against the snapshot before.

    New and changed rows as they are, removed rows as they were; the first snapshot is new as a whole. Merge such
    loads with ``on_same_hash='close'``. The load replaces an earlier run of its day, like any silver load."""
    started, day = _now(), to_day(run_date)
    days = snapshot_days(spark, layout.bronze(spec.source_path), day)
    with scratch_scope(spark):
        rows = silver_frame(spark, layout, spec, run_date)
        if days[:-1]:  # raises if a snapshot has different rows for one key
            rows = snapshot_diff(silver_frame(spark, layout, spec, days[-2]), rows).drop(CHANGE_COL)
        elif not spec.first_per_key:
            rows = materialize(rows, "first-snapshot")
            check_load(rows)
        obs = Observation(f"difference_{spec.table_name}")
        rows = add_load_date(rows, run_date).observe(obs, F.count(F.lit(1)).alias("rows"))
        append_silver(rows, layout.silver(spec.table_name))
    n = observed(obs).get("rows") or 0
    if not n:
        mark_empty_load(spark, layout.silver(spec.table_name), day)
    return _audit(run_date, "silver", spec.table_name, "ok", started, rows_out=n, message=f"difference to {days[-2]}" if days[:-1] else None)


# ---------------------------------------------------------------- gold
def load_gold(
    spark: SparkSession,
    layout: Layout,
    table_name: str,
    run_date,
    on_same_hash: str = IGNORE,
    close_missing: bool = False,
    retain_versions: int | None = None,
) -> dict:
    """Create or merge one dimension from every silver load, up to the run date, that gold does not hold yet.

    Loads are merged in order, each stamped with its own day (the run's own load with the run's time). Gold
    records the last one, so a repeated run changes nothing, and a run dated before it is an error. Silver
    missing or without rows -> skipped; an empty load is passed over. The ``DIM1_``/``DIM2_`` prefix picks the
    SCD type; any other prefix raises.
    """
    started = _now()
    silver_path = layout.silver(table_name)
    if not path_exists(spark, silver_path):
        return _audit(run_date, "gold", table_name, "skipped", started, message=f"silver table {silver_path} does not exist")
    kind = scd_type(table_name)
    loads = silver_loads(spark, silver_path)
    if loads:
        day, last = to_day(run_date), last_load(spark, layout.gold(table_name))
        if last and day < last:
            raise ValueError(f"{table_name} holds the load of {last}; it cannot be run for {day}")
        pending = [x for x in loads if x <= day and (not last or x > last) and not load_is_empty(spark, silver_path, x)]
        if not pending:
            message = f"no load with rows after {last}" if last else f"no load with rows up to {day}"
            return _audit(run_date, "gold", table_name, "skipped", started, message=message)
        done = [
            merge_into_gold(
                spark, layout, table_name, read_load(spark, silver_path, x), run_date if x == day else x, on_same_hash,
                close_missing, kind, started, retain_versions, load=x, ordered=load_is_ordered(spark, silver_path, x),
            )
            for x in pending
        ]
        total = lambda c: sum(d[c] for d in done) if all(d[c] is not None for d in done) else None
        return {
            **done[-1], "run_date": day, "status": done[0]["status"], "inserted": total("inserted"), "closed": total("closed"),
            "message": f"loads {', '.join(pending)}" if len(pending) > 1 else None,
        }
    else:  # a table without load partitions: read it whole, skip it when it has no data
        try:
            source = spark.read.parquet(silver_path)
        except Exception:  # no data files to infer a schema from
            return _audit(run_date, "gold", table_name, "skipped", started, message="silver table holds no data")
        if source.isEmpty():
            return _audit(run_date, "gold", table_name, "skipped", started, message="silver table is empty")
    return merge_into_gold(
        spark, layout, table_name, source, run_date, on_same_hash, close_missing, kind, started, retain_versions
    )


def merge_into_gold(
    spark: SparkSession,
    layout: Layout,
    table_name: str,
    source: DataFrame,
    run_date,
    on_same_hash: str = IGNORE,
    close_missing: bool = False,
    kind: int | None = None,
    started: _dt.datetime | None = None,
    retain_versions: int | None = None,
    load: str | None = None,
    ordered: bool = False,
) -> dict:
    """Create the dimension from ``source`` or merge ``source`` into it; write the next version.

    ``retain_versions``: afterwards keep only the newest that many versions (default: keep all).
    ``load``: the load that ``source`` is, recorded with the version. ``ordered``: its files hold one row per key in key order."""
    started = started or _now()
    kind = kind or scd_type(table_name)
    keys = key_columns(source.columns)
    gold_path = layout.gold(table_name)
    stamp = to_stamp(run_date)
    with scratch_scope(spark):
        return _create_or_merge(
            spark, table_name, source, run_date, on_same_hash, close_missing, kind, started, retain_versions,
            keys, gold_path, stamp, load, ordered,
        )


def _create_or_merge(
    spark, table_name, source, run_date, on_same_hash, close_missing, kind, started, retain_versions, keys, gold_path,
    stamp, load, ordered,
) -> dict:
    exists = table_exists(spark, gold_path)
    if exists and kind == 2:
        counts = merge_type2_table(spark, gold_path, source, keys, stamp, on_same_hash, close_missing, load, ordered)
    else:
        if exists:
            gold = read_table(spark, gold_path)
            sk = sk_column(gold.columns)
            before = max_value(gold, sk)  # known anyway, for the count of inserted rows
            out = scd1_merge(gold, source, keys, max_sk=before)
        else:
            sk, before = sk_name_for(table_name), 0
            create = scd1_create if kind == 1 else scd2_create
            in_order = ordered and bool(keys) and sk not in source.columns
            rows = no_null_keys(source, keys) if in_order else unique_rows(source, keys, allow_null_keys=False, by_range=True)
            out = translate_errors(create, rows, keys, sk, unique_keys=True, by_range=not in_order, in_files=in_order)
        obs = Observation(f"gold_{table_name}")
        new = F.sum((F.col(sk) > F.lit(before)).cast("long"))
        out = out.observe(obs, F.count(F.lit(1)).alias("rows_out"), new.alias("inserted"))
        translate_errors(write_table, out, gold_path, load)
        counts = {k: obs.get[k] for k in ("rows_out", "inserted")}
        if kind == 2:
            counts |= {"closed": 0, "n_open": counts["rows_out"]}
    if retain_versions:
        prune_versions(spark, gold_path, retain_versions)
    return _audit(run_date, "gold", table_name, "merged" if exists else "created", started, **counts)


def merge_type2_table(
    spark: SparkSession,
    gold_path: str,
    source: DataFrame,
    keys: Sequence[str],
    stamp: str,
    on_same_hash: str = IGNORE,
    close_missing: bool = False,
    load: str | None = None,
    in_files: bool = False,
) -> dict:
    """Merge ``source`` into a type 2 table: the open versions are written anew, those that close are appended to
    the closed ones. Closed rows are neither rewritten nor read, but for the key columns when a key without an open
    version is inserted. A change of a column's type rewrites the table whole."""
    own, closed = read_own_rows(spark, gold_path), read_closed(spark, gold_path)
    sk = sk_column(own.columns)
    moved = own.filter(~is_open_version())  # of a version written whole; pushed down, so none are read otherwise
    moved = None if moved.isEmpty() else moved
    history = closed if moved is None else moved if closed is None else closed.unionByName(moved)
    change = scd2_change(
        own.filter(is_open_version()), source, history, keys, stamp, on_same_hash, close_missing,
        max_sk=max_frame(sk, own, closed), in_files=in_files,
    )
    inserted, ended = change.counts()
    obs = Observation(f"open_{stamp}")
    rows = change.open_rows().observe(obs, F.count(F.lit(1)).alias("rows"))
    types = {f.name: f.dataType for f in own.schema}
    if any(types.get(f.name, f.dataType) != f.dataType for f in rows.schema):
        whole = rows.unionByName(change.ended())
        if history is not None:
            whole = whole.unionByName(with_new_columns(history, source))
        write_table(whole, gold_path, load)
    else:
        leave = change.ended() if ended else None
        if moved is not None:
            leave = change.ended().unionByName(with_new_columns(moved, source))
        append_closed(leave, rows, gold_path, load)
    n_open = observed(obs).get("rows") or 0
    return {"rows_out": read_table(spark, gold_path).count(), "inserted": inserted, "closed": ended, "n_open": n_open}


def run_gold(
    spark: SparkSession, layout: Layout, tables: Iterable[str], run_date, parallelism: int | None = None,
    log: list[dict] | None = None, **merge_options,
) -> list[dict]:
    return _each_table(
        tables, lambda t: load_gold(spark, layout, t, run_date, **merge_options), parallelism, spark,
        lambda t: f"gold {t} {to_day(run_date)}", log,
        lambda t, m: _audit(run_date, "gold", t, "failed", _now(), message=m),
    )


# ---------------------------------------------------------------- facts
@dataclass(frozen=True)
class FactSpec:
    """A gold fact table: the newest load of a silver table with business keys replaced by SKs.

    ``lookups``: ``{"dim": "DIM2_customer", "keys": ["o_custkey"], "as_of": "o_orderdate"}`` per dimension
    (``as_of`` optional: without it the current version is used; ``name``: of the surrogate key column, needed
    where one dimension plays several roles).

    ``keep_keys``: the business keys stay in the fact. Rows that were loaded with an unknown key are then resolved
    by a later run, once the dimension has the key.
    """

    table_name: str
    silver_table: str
    lookups: Sequence[Mapping] = ()
    keep_keys: bool = False

    @classmethod
    def from_record(cls, r: Mapping) -> FactSpec:
        return cls(r["table_name"], r["silver_table"], tuple(dict(x) for x in (r.get("lookups") or ())), bool(r.get("keep_keys")))


FACT_SPEC_SCHEMA = (
    "table_name string, silver_table string, "
    "lookups array<struct<dim:string, keys:array<string>, as_of:string, name:string>>, keep_keys boolean"
)


def _lookups(spark: SparkSession, layout: Layout, spec: FactSpec, keep_keys: bool) -> list[DimLookup]:
    found = [
        DimLookup(
            read_table(spark, layout.gold(lk["dim"])), list(lk["keys"]), as_of=lk.get("as_of"), name=lk.get("name"), keep_keys=keep_keys
        )
        for lk in spec.lookups
    ]
    for lk, path in zip(found, (layout.gold(lk["dim"]) for lk in spec.lookups)):
        # a version of the dimension is checked once; its folder never changes afterwards
        checked = f"{current_version_path(spark, path)}/_checked_{'-'.join(lk.dim_keys or ('keys',))}"
        if not path_exists(spark, checked):
            check_versions(lk.dim, lk.dim_keys)
            touch(spark, checked)
    return found


def resolve_late_members(spark: SparkSession, layout: Layout, spec: FactSpec) -> tuple[int, list[str]]:
    """Give facts that were loaded with an unknown key their SK, where the dimension has the key by now.

    Only rows with an unknown SK are looked up, first with their keys alone. The loads (``LoadDate`` partitions) in which
    one is found are written anew; all other partitions keep their files. Returns rows resolved and loads rewritten."""
    gold_path = layout.gold(spec.table_name)
    if not spec.keep_keys or not silver_loads(spark, gold_path):
        return 0, []
    fact = read_silver(spark, gold_path, newest_only=False)
    lookups = _lookups(spark, layout, spec, keep_keys=True)
    sks = [lk.sk_name for lk in lookups]
    unknown = functools.reduce(lambda x, y: x | y, [F.col(c) == UNKNOWN_SK for c in sks])
    asked = {c for lk in lookups for c in [*lk.fact_keys, *([lk.as_of] if lk.as_of else [])]}

    def looked_up(rows: DataFrame) -> DataFrame:
        """Unknown SKs asked for again, known ones as they are."""
        rows = load_fact(rows.withColumnsRenamed({c: f"_ll_had_{c}" for c in sks}), lookups)
        new = {c: F.when(F.col(f"_ll_had_{c}") == UNKNOWN_SK, F.col(c)).otherwise(F.col(f"_ll_had_{c}")) for c in sks}
        found = sum((F.col(f"_ll_had_{c}") != new[c]).cast("int") for c in sks)
        return rows.withColumn("_ll_found", found).withColumns(new)

    seen = looked_up(fact.filter(unknown).select(LOAD_DATE_COL, *sorted(asked - {LOAD_DATE_COL}), *sks))
    loads = dict(seen.filter("_ll_found > 0").groupBy(LOAD_DATE_COL).agg(F.sum("_ll_found")).collect())  # a row per load
    if loads:
        part = fact.filter(F.col(LOAD_DATE_COL).isin(sorted(loads)))
        with scratch_scope(spark):
            rows = looked_up(part.filter(unknown)).select(*fact.columns).unionByName(part.filter(~unknown))
            append_silver(materialize(rows, "late-members"), gold_path)  # written first: it replaces what it reads
    return sum(loads.values()), sorted(loads)


def load_fact_table(spark: SparkSession, layout: Layout, spec: FactSpec, run_date) -> dict:
    """Write silver loads, keys replaced by SKs, as ``LoadDate`` partitions of the gold fact: those up to the run
    date that it does not hold yet, and the run's own (replaced on a re-run). Empty loads are passed over."""

    started = _now()
    silver_path = layout.silver(spec.silver_table)
    if not path_exists(spark, silver_path):
        return _audit(run_date, "gold", spec.table_name, "skipped", started, message=f"silver table {silver_path} does not exist")
    day, gold_path = to_day(run_date), layout.gold(spec.table_name)
    late, _ = resolve_late_members(spark, layout, spec)
    note = f"{late} late keys resolved" if late else None
    held = set(silver_loads(spark, gold_path))
    pending = [x for x in silver_loads(spark, silver_path) if x == day or x < day and x not in held]
    pending = [x for x in pending if not load_is_empty(spark, silver_path, x)]
    if not pending:
        return _audit(run_date, "gold", spec.table_name, "skipped", started, message=note or f"no load with rows to take up to {day}")
    lookups = _lookups(spark, layout, spec, spec.keep_keys)
    rows = missing = 0
    for load in pending:
        out = load_fact(read_load(spark, silver_path, load), lookups)
        obs = Observation(f"fact_{spec.table_name}_{load}")
        unknown = [F.sum((F.col(lk.sk_name) == -1).cast("long")).alias(f"unknown_{i}") for i, lk in enumerate(lookups)]
        out = out.observe(obs, F.count(F.lit(1)).alias("rows"), *unknown)
        append_silver(out, gold_path)  # one partition per load, replaced on a re-run
        rows += obs.get["rows"]
        missing += sum(v or 0 for k, v in obs.get.items() if k.startswith("unknown_"))
    return _audit(run_date, "gold", spec.table_name, "loaded", started, rows_in=rows, rows_out=rows,
                  message="; ".join([*([note] if note else []), *([f"{missing} keys without a dimension row"] if missing else [])]) or None)


def run_facts(
    spark: SparkSession, layout: Layout, specs: Iterable[FactSpec], run_date, parallelism: int | None = None,
    log: list[dict] | None = None,
):
    return _each_table(
        specs, lambda s: load_fact_table(spark, layout, s, run_date), parallelism, spark,
        lambda x: f"fact {x.table_name} {to_day(run_date)}", log,
        lambda x, m: _audit(run_date, "gold", x.table_name, "failed", _now(), message=m),
    )


def register_gold_views(spark: SparkSession, layout: Layout, tables: Iterable[str]) -> list[str]:
    """Temp views for SQL access: ``<table>`` (all rows) and, for SCD2 tables, ``<table>_current``."""
    names = []
    for t in tables:
        path = layout.gold(t)
        df = read_table(spark, path) if table_exists(spark, path) else spark.read.parquet(path)
        df.createOrReplaceTempView(t)
        names.append(t)
        if UPDATED_COL in df.columns:
            own = read_own_rows(spark, path) if table_exists(spark, path) else df
            own.filter(F.col(UPDATED_COL) == F.lit(OPEN_END)).createOrReplaceTempView(f"{t}_current")
            names.append(f"{t}_current")
    return names


def register_gold_tables(spark: SparkSession, layout: Layout, tables: Iterable[str], prefix: str = "") -> list[str]:
    """Objects of the catalog for SQL access from any session that shares it: per table, external tables over its files
    and the views ``<prefix><table>`` (all rows) and, for type 2, ``<prefix><table>_current``.

    Call it after a load: the tables point at files, so registering them anew moves no data. ``prefix`` may name a
    database (``"sales."``)."""
    names = []
    for t in tables:
        path, name = layout.gold(t), f"{prefix}{t}"
        if not table_exists(spark, path):  # a fact: partitions of its loads
            _external(spark, f"{name}_files", spark.read.parquet(path), path, LOAD_DATE_COL)
            parts = [f"SELECT * FROM {name}_files"]
        else:
            own, version = read_own_rows(spark, path), current_version(spark, path)
            _external(spark, f"{name}_files", own, current_version_path(spark, path))
            parts = [f"SELECT * FROM {name}_files"]
            if read_closed(spark, path) is not None:
                _external(spark, f"{name}_closed_files", own.withColumn("n", F.lit(0)), closed_folder(spark, path, version.number), "n")
                cols = ", ".join(f"`{c}`" for c in own.columns)
                parts.append(f"SELECT {cols} FROM {name}_closed_files WHERE n <= {version.number}")
            if UPDATED_COL in own.columns:
                spark.sql(f"CREATE OR REPLACE VIEW {name}_current AS {parts[0]} WHERE {UPDATED_COL} = '{OPEN_END}'")
                names.append(f"{name}_current")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(parts)}")
        names.append(name)
    return names


def _external(spark: SparkSession, name: str, like: DataFrame, path: str, part: str | None = None) -> None:
    """An external table with the columns of ``like`` over the files of ``path``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    by = f"PARTITIONED BY ({part})" if part else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{path}'")
    if part:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


# ---------------------------------------------------------------- full run
KEPT = "kept"  # left out by a resumed run
FINISHED = ("ok", "created", "merged", "loaded", KEPT)


def finished_tables(spark: SparkSession, layout: Layout, run_date) -> set[tuple[str, str]]:
    """(layer, table) whose last entry in the run log of the day says that they are done; a row per table and layer."""
    if not path_exists(spark, layout.audit()):
        return set()
    log = spark.read.schema(AUDIT_SCHEMA).parquet(layout.audit()).filter(F.col("run_date") == to_day(run_date))
    last = log.groupBy("layer", "table_name").agg(F.max_by("status", F.struct("finished", "started")).alias("status"))
    return {(r.layer, r.table_name) for r in last.filter(F.col("status").isin(*FINISHED)).collect()}


def audit_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def run_layers(
    spark: SparkSession,
    layout: Layout,
    bronze_entries: Iterable[Mapping],
    silver_specs: Iterable[SilverSpec],
    gold_tables: Iterable[str],
    run_date,
    write_audit: bool = True,
    parallelism: int | None = None,
    fact_specs: Iterable[FactSpec] = (),
    resume: bool = False,
    **merge_options,
) -> DataFrame:
    """Bronze, then silver, then gold dimensions, then gold facts; a failing layer stops the run.

    The run log gets a row for every table that ran, also when the run fails. With ``resume`` the run reads the log of
    its day first and leaves out tables that an earlier run finished (logged as ``kept``).

    Within a layer the tables load concurrently (``parallelism`` tables at a time, default up to 8).
    """
    rows: list[dict] = []
    done = finished_tables(spark, layout, run_date) if resume else set()

    def left(layer: str, items: Iterable, name: Callable) -> list:
        """The tables still to do; the others are logged."""
        todo = []
        for x in items:
            if (layer, name(x)) in done:
                rows.append(_audit(run_date, layer, name(x), KEPT, _now(), message="finished by an earlier run of the day"))
            else:
                todo.append(x)
        return todo

    of_spec = lambda s: s.table_name
    try:
        run_bronze(spark, layout, left("bronze", bronze_entries, lambda e: e["target_name"]), run_date, parallelism, rows)
        run_silver(spark, layout, left("silver", silver_specs, of_spec), run_date, parallelism, rows)
        run_gold(spark, layout, left("gold", gold_tables, str), run_date, parallelism, rows, **merge_options)
        run_facts(spark, layout, left("gold", fact_specs, of_spec), run_date, parallelism, rows)
    finally:
        if write_audit and rows:
            audit_frame(spark, rows).write.mode("append").parquet(layout.audit())
    return audit_frame(spark, rows)


def _silver_specs(records: list[dict], registry: Mapping[str, SilverSpec] | None) -> list[SilverSpec]:
    """Full spec objects, or ``{notebook_path, table_name}`` objects resolved through ``registry``."""
    out = []
    for r in records:
        if r.get("source_name"):
            out.append(SilverSpec.from_record(r))
        elif registry is not None and r.get("table_name") in registry:
            out.append(registry[r["table_name"]])
        else:
            raise KeyError(f"silver config for {r.get('table_name')!r} names no source and no registered spec")
    return out


def run_from_config(
    spark: SparkSession,
    layout: Layout,
    run_date,
    silver_registry: Mapping[str, SilverSpec] | None = None,
    **merge_options,
) -> DataFrame:
    """Drive a run from ``config/bronze.json``, ``config/silver.json``, ``config/gold.json`` and, if present,
    ``config/facts.json``. Silver objects either carry a full spec or only ``notebook_path``/``table_name``,
    resolved through ``silver_registry`` (table name -> :class:`SilverSpec`)."""
    bronze = config_records(read_config(spark, layout.config("bronze.json"), f"{BRONZE_SCHEMA}, {CSV_SCHEMA}"))
    silver_records = config_records(read_config(spark, layout.config("silver.json"), SILVER_SPEC_SCHEMA + ", notebook_path string"))
    silver = _silver_specs(silver_records, silver_registry)
    gold = [r["table_name"] for r in config_records(read_config(spark, layout.config("gold.json"), GOLD_SCHEMA))]
    facts = []
    if path_exists(spark, layout.config("facts.json")):
        facts = [FactSpec.from_record(r) for r in config_records(read_config(spark, layout.config("facts.json"), FACT_SPEC_SCHEMA))]
    return run_layers(spark, layout, bronze, silver, gold, run_date, fact_specs=facts, **merge_options)
