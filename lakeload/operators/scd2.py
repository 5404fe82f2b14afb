"""Slowly changing dimension, type 2: versioned rows with ``[created_date, updated_date)`` ranges.

A merge is expressed as DataFrame operators (no table format with row-level merge is required):

* open version per key: one partial-aggregated ``max(struct(SK, hash, created, updated))`` of the open rows;
* action table: source LEFT JOIN open version on the keys (both sides unique per key);
* closes: the SKs of open versions to end; applied to the *open* rows only (at most one per key) by a broadcast bit for
  each SK, closed history passes through untouched;
* inserts: numbered with the distributed numbering after ``max(SK)``. Closed history is asked (key columns only)
  about inserted keys that have no open version, to tell a returning key from a new one.

:func:`scd2_change` gives the closed and the open versions apart, so that a table can append the former and
rewrite the latter; :func:`scd2_merge` puts them together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.dates import stamp_to_timestamp, to_stamp
from lakeload.functions.hashing import pack_hashes, unpack_hashes
from lakeload.operators._joins import SRC, key_condition, max_frame, no_null_keys, prefixed, translate_errors, unique_rows
from lakeload.operators._marks import MARK, with_mark
from lakeload.operators.numbering import MAX_NUMBER, number_in_files, number_rows
from lakeload.operators.prepare import hash_key
from lakeload.plans.roles import (
    ACTION_COL,
    CREATED_COL,
    DEFAULT_START,
    DELETE,
    EXIST_INSERT,
    HASH_COL,
    LOAD_DATE_COL,
    NEW_INSERT,
    OPEN_END,
    UPDATE,
    UPDATED_COL,
    resolve_keys,
    sk_column,
    sk_name_for,
)
from lakeload.sources.store import materialize

IGNORE = "ignore"
CLOSE = "close"
_T = "_t_"
_V = "_ll_v"
_ACT = "_ll_act"
_OLD = "_ll_old_hash"
_AT, _RANK, _BASE = "_ll_at", "_ll_rank", "_ll_base"


def scd2_create(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    sk: str | None = None,
    table_name: str | None = None,
    num_partitions: int | None = None,
    unique_keys: bool = False,
    by_range: bool = False,
    in_files: bool = False,
) -> DataFrame:
    """Source rows + ``SK_<name>`` 1..n in key order + default validity (open since 1900).

    ``unique_keys=True`` declares one row per key (e.g. after the merge-source check), ``by_range=True`` that
    the rows are dealt out by ranges of the keys, ``in_files=True`` that they lie so in the files they are read from."""
    ks = resolve_keys(df.columns, keys)
    name = sk or sk_name_for(table_name or "")
    numbered = number_in_files(df, name) if in_files else number_rows(df, ks, name, 0, num_partitions, unique=unique_keys, by_range=by_range)
    return numbered.withColumns(
        {CREATED_COL: F.lit(DEFAULT_START), UPDATED_COL: F.lit(OPEN_END)}
    )


def _latest_state(gold: DataFrame, keys: Sequence[str], sk: str) -> DataFrame:
    """keys + ``_t_SK, _t_HASHCOLUMN, _t_created_date, _t_updated_date`` of the highest-SK version."""
    state = pack_hashes(gold.select(*keys, sk, HASH_COL, CREATED_COL, UPDATED_COL))
    v = F.max(F.struct(*[F.col(c) for c in state.columns if c not in keys])).alias(_V)
    state = unpack_hashes(state.groupBy(*keys).agg(v).select(*keys, f"{_V}.*"))
    return state.select(
        *keys,
        F.col(sk).alias(_T + "sk"),
        *[F.col(c).alias(_T + c) for c in (HASH_COL, CREATED_COL, UPDATED_COL)],
    )


def scd2_latest(gold: DataFrame, keys: Sequence[str] | None = None, method: str = "max_struct") -> DataFrame:
    """Full rows of the highest-SK version per key.

    ``max_struct``: one aggregate over the whole row, one shuffle. ``join``: group max of the SK,
    then join back on keys + SK (two scans of the table, the textbook formulation).
    """
    ks = resolve_keys(gold.columns, keys)
    sk = sk_column(gold.columns)
    others = [c for c in gold.columns if c not in ks and c != sk]
    if method == "max_struct":
        v = F.max(F.struct(F.col(sk), *[F.col(c) for c in others])).alias(_V)
        return gold.groupBy(*ks).agg(v).select(*ks, *[F.col(f"{_V}.{c}").alias(c) for c in [sk, *others]]).select(
            *gold.columns
        )
    if method == "join":
        top = gold.groupBy(*ks).agg(F.max(sk).alias(sk))
        return gold.join(top, [*ks, sk], "inner").select(*gold.columns)
    raise ValueError(f"unknown method {method!r}")


def _same() -> Column:
    """The open version holds the source row already (``_OLD``: the source's hash over gold's own columns)."""
    return F.col(_T + HASH_COL).isin(F.col(SRC + HASH_COL), F.col(SRC + _OLD))


def _action(now: str) -> tuple[Column, Column, Column]:
    """Three questions name the action (is there a version, is it open, does it hold the same row); each action
    has one pair of dates."""
    known, is_open = F.col(_T + "sk").isNotNull(), F.col(_T + UPDATED_COL) == F.lit(OPEN_END)
    for_known = F.when(~is_open, EXIST_INSERT).otherwise(F.when(_same(), DELETE).otherwise(UPDATE))
    for_source = F.when(known, for_known).otherwise(NEW_INSERT)
    action = F.when(F.col(SRC + HASH_COL).isNotNull(), for_source)
    began = F.col(_T + CREATED_COL)
    dates = {
        NEW_INSERT: (F.lit(DEFAULT_START), F.lit(OPEN_END)),
        EXIST_INSERT: (F.lit(now), F.lit(OPEN_END)),
        UPDATE: (began, F.lit(now)),
        DELETE: (began, F.lit(now)),
    }
    created, updated = (F.coalesce(*[F.when(F.col(_ACT) == k, d[n]) for k, d in dates.items()]) for n in (0, 1))
    return action, created, updated


def _actions_frame(source: DataFrame, gold: DataFrame, ks: list[str], sk: str, now: str, how: str, null_safe: bool):
    latest = _latest_state(gold, ks, sk)
    if _OLD not in source.columns:
        source = source.withColumn(_OLD, F.col(HASH_COL))
    src = prefixed(source, SRC)
    cond = key_condition([SRC + k for k in ks], ks, null_safe)
    action, _, _ = _action(now)
    return src.join(latest, cond, how).withColumn(_ACT, action)


def scd2_actions(
    source: DataFrame,
    gold: DataFrame,
    keys: Sequence[str] | None = None,
    now=None,
    null_safe_keys: bool = False,
) -> DataFrame:
    """All source columns + ``Action``, ``created_date``, ``updated_date`` (label-for-label table)."""
    ks = resolve_keys(gold.columns, keys)
    sk = sk_column(gold.columns)
    stamp = to_stamp(now)
    df = _actions_frame(source, gold, ks, sk, stamp, "left", null_safe_keys)
    _, created, updated = _action(stamp)
    return df.select(
        *[F.col(SRC + c).alias(c) for c in source.columns],
        F.col(_ACT).alias(ACTION_COL),
        created.alias(CREATED_COL),
        updated.alias(UPDATED_COL),
    )


@dataclass(frozen=True)
class Scd2Change:
    """What a merge does to the open versions of a dimension."""

    current: DataFrame  # the open versions before it
    closes: DataFrame  # the SKs of those that it closes
    inserts: DataFrame  # the versions that it adds
    changes: DataFrame  # the numbered action table (materialised)
    stamp: str  # when it closes and inserts them

    def _sk(self) -> str:
        return sk_column(self.current.columns)

    def _marked(self) -> DataFrame:
        """The open versions and whether they close: by a bit for each SK, so they are not shuffled."""
        return with_mark(self.current, self._sk(), self.closes.select(self._sk()))

    def ended(self) -> DataFrame:
        """The versions that close, with their end."""
        rows = self._marked().filter(MARK).withColumn(UPDATED_COL, F.lit(self.stamp))
        return rows.select(*self.current.columns)

    def open_rows(self) -> DataFrame:
        """All open versions after the merge."""
        stay = self._marked().filter(~F.col(MARK)).select(*self.current.columns)
        return stay.unionByName(self.inserts)

    def all_rows(self) -> DataFrame:
        """Both, in one pass over the open versions."""
        end = F.when(F.col(MARK), F.lit(self.stamp)).otherwise(F.col(UPDATED_COL))
        rows = self._marked().withColumn(UPDATED_COL, end)
        return rows.select(*self.current.columns).unionByName(self.inserts)

    def counts(self) -> tuple[int, int]:
        """(inserted, closed) from two columns of the action table."""
        n = [F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)) for c in ("_ll_insert", "_ll_close")]
        return tuple(self.changes.agg(*n).first())


def with_new_columns(gold: DataFrame, source: DataFrame) -> DataFrame:
    """``gold`` with the columns that only ``source`` has, as NULL."""
    added = [c for c in source.columns if c not in gold.columns]
    return gold.withColumns({c: F.lit(None).cast(source.schema[c].dataType) for c in added}) if added else gold


def is_open_version() -> Column:
    return F.col(UPDATED_COL).eqNullSafe(F.lit(OPEN_END))


def _flags(stamp: str, on_same_hash: str, close_missing: bool) -> tuple[Column, Column, Column]:
    """Of an action: does it close the open version, insert one, amend it by new columns."""
    act = F.col(_ACT)
    close_if = act == UPDATE
    if on_same_hash == CLOSE:
        close_if = close_if | (act == DELETE)
    if close_missing:
        close_if = close_if | F.col(SRC + HASH_COL).isNull()
    insert_if = act.isin(NEW_INSERT, UPDATE)
    amend_if = (act == DELETE) & (F.col(_T + HASH_COL) != F.col(SRC + HASH_COL)) & ~F.coalesce(close_if, F.lit(False))
    back_dated = F.raise_error(F.lit(f"run date {stamp} lies before the start of a version that it would close"))
    close_if = F.when(close_if & (F.col(_T + CREATED_COL) > F.lit(stamp)), back_dated.cast("boolean")).otherwise(close_if)
    return tuple(F.coalesce(c, F.lit(False)) for c in (close_if, insert_if, amend_if))


def _changed_in_files(source, current, ks, sk, stamp, how, null_safe, on_same_hash, base) -> tuple[DataFrame, DataFrame]:
    """The action table (narrow, staged) and the inserted rows of a ``source`` that lies in files in key order.

    Keys and 128 bits of the hashes meet in a join; the rows to insert are found again by their place in the files, a bit for
    each, and numbered by counting the bits before theirs. No whole row is shuffled."""
    narrow = lambda df, *cols: df.select(*cols, F.unhex(F.md5(F.col(HASH_COL).cast("string"))).alias(HASH_COL))
    keyed = source if null_safe else no_null_keys(source, ks)
    state = narrow(current, *ks, sk, CREATED_COL, UPDATED_COL)
    acts = _actions_frame(narrow(keyed, *ks, _AT), state, ks, sk, stamp, how, null_safe)
    close_if, insert_if, _ = _flags(stamp, on_same_hash, how == "full")
    staged = acts.select(
        F.col(SRC + _AT).alias(_AT), F.col(_T + "sk"), F.col(_ACT), close_if.alias("_ll_close"), insert_if.alias("_ll_insert")
    )
    staged = translate_errors(materialize, staged.filter(F.col("_ll_close") | F.col("_ll_insert")), "changes")
    added = staged.filter("_ll_insert")
    rows = with_mark(source, _AT, added.select(_AT), rank=_RANK).filter(MARK).drop(MARK)
    rows = with_mark(rows, _AT, added.filter(F.col(_ACT) == NEW_INSERT).select(_AT))
    if isinstance(base, DataFrame):  # one row
        rows = rows.join(F.broadcast(base.toDF(_BASE)))
    else:
        rows = rows.withColumn(_BASE, F.lit(int(base)).cast("bigint"))
    past = F.raise_error(F.lit(f"{sk} would pass the largest bigint")).cast("bigint")
    number = F.when(F.col(_RANK) > F.lit(MAX_NUMBER) - F.col(_BASE), past).otherwise(F.col(_RANK) + F.col(_BASE))
    return staged, rows.withColumns({sk: number, _ACT: F.when(F.col(MARK), NEW_INSERT).otherwise(UPDATE)})


def scd2_change(
    current: DataFrame,
    source: DataFrame,
    closed: DataFrame | None = None,
    keys: Sequence[str] | None = None,
    now=None,
    on_same_hash: str = IGNORE,
    close_missing: bool = False,
    null_safe_keys: bool = False,
    check_source: bool = True,
    num_partitions: int | None = None,
    max_sk: int | DataFrame | None = None,
    in_files: bool = False,
) -> Scd2Change:
    """Merge ``source`` into the open versions ``current`` (rules: :func:`scd2_merge`).

    ``in_files=True`` declares that ``source`` is read from Parquet files with one row per key in key order; its rows then
    stay where they are (:func:`_changed_in_files`). NULL keys still fail.

    ``closed``: the closed versions. Only their key columns are read, and only if keys without an open version
    are inserted. ``max_sk``: the highest SK of both (default: found and kept in a scratch file of one row)."""
    if on_same_hash not in (IGNORE, CLOSE):
        raise ValueError(f"on_same_hash must be {IGNORE!r} or {CLOSE!r}")
    ks = resolve_keys(current.columns, keys)
    sk = sk_column(current.columns)
    stamp = to_stamp(now)
    added = [c for c in source.columns if c not in current.columns]
    # written like the numbering that takes it: a plan that holds its gold for each use would grow by a multiple per merge
    base = translate_errors(materialize, max_frame(sk, current, closed), "highest") if max_sk is None else max_sk
    current = with_new_columns(current, source)
    data_cols = [c for c in current.columns if c not in (sk, CREATED_COL, UPDATED_COL)]
    missing = [c for c in data_cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks gold columns {missing}")
    in_place = in_files and not added
    source = source.select(*data_cols) if not in_place else number_in_files(source, _AT).select(*data_cols, _AT)
    if added:
        source = hash_key(source, _OLD, ignore=(LOAD_DATE_COL, HASH_COL, *added))
    if check_source and not in_place:
        source = unique_rows(source, ks, null_safe_keys)

    how = "full" if close_missing else "left"
    if in_place:
        numbered, rows = _changed_in_files(source, current, ks, sk, stamp, how, null_safe_keys, on_same_hash, base)
        rows = rows.select(*data_cols, sk, _ACT, F.lit(OPEN_END).alias(UPDATED_COL))
    else:
        acts = _actions_frame(source, current, ks, sk, stamp, how, null_safe_keys)
        close_if, insert_if, amend_if = _flags(stamp, on_same_hash, close_missing)
        staged = acts.select(
            *[F.col(SRC + c) for c in data_cols],
            F.col(_T + "sk"),
            F.col(_ACT),
            close_if.alias("_ll_close"),
            insert_if.alias("_ll_insert"),
            amend_if.alias("_ll_amend"),
        ).filter(F.col("_ll_close") | F.col("_ll_insert") | F.col("_ll_amend"))
        # One materialised, numbered action table feeds closes and inserts: ordering inserts first
        # (then by key) makes the inserts' numbers 1..k in key order; the other rows' numbers are unused.
        staged = staged.withColumn("_ll_grp", F.when(F.col("_ll_insert"), F.lit(0)).otherwise(F.lit(1)))
        # (group, source keys, target SK) is unique: closes of keys missing from the source (NULL source
        # keys) are told apart by the SK of the version they close, so they spread over range partitions.
        numbered = translate_errors(
            number_rows, staged, ["_ll_grp", *[SRC + k for k in ks], _T + "sk"], "_ll_new_sk", base, num_partitions,
            unique=check_source,
        )
        rows = numbered.filter("_ll_insert").select(
            *[F.col(SRC + c).alias(c) for c in data_cols],
            F.col("_ll_new_sk").alias(sk),
            F.col(_ACT),
            F.lit(OPEN_END).alias(UPDATED_COL),
        )

    closes = numbered.filter("_ll_close").select(F.col(_T + "sk").alias(sk))
    act = F.col(_ACT)
    returning = F.lit(False)
    if closed is not None:
        # the few inserted keys meet the closed rows' key columns; no closed row is shuffled while they are few
        kk = ["_ll_k_" + k for k in ks]
        fresh = rows.filter(act == NEW_INSERT).select(*[F.col(k).alias(n) for k, n in zip(ks, kk)])
        known = closed.select(*ks).join(fresh, key_condition(ks, kk, null_safe_keys), "left_semi").distinct()
        known = known.select(*[F.col(k).alias(n) for k, n in zip(ks, kk)], F.lit(True).alias("_ll_known"))
        rows = rows.join(known, key_condition(ks, kk, null_safe_keys), "left")
        returning = F.coalesce(F.col("_ll_known"), F.lit(False))
    began = F.when((act == NEW_INSERT) & ~returning, F.lit(DEFAULT_START)).otherwise(F.lit(stamp))
    inserts = rows.withColumn(CREATED_COL, began).select(*current.columns)

    if added:
        new = [*added, HASH_COL]
        amended = numbered.filter("_ll_amend").select(
            F.col(_T + "sk").alias(sk), *[F.col(SRC + c).alias("_ll_n_" + c) for c in new]
        )
        took = F.col("_ll_n_" + HASH_COL).isNotNull()
        current = current.join(amended, sk, "left").select(
            *[F.when(took, F.col("_ll_n_" + c)).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in current.columns]
        )
    return Scd2Change(current, closes, inserts, numbered, stamp)


def scd2_merge(
    gold: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | None = None,
    now=None,
    on_same_hash: str = IGNORE,
    close_missing: bool = False,
    null_safe_keys: bool = False,
    check_source: bool = True,
    num_partitions: int | None = None,
    max_sk: int | DataFrame | None = None,
) -> DataFrame:
    """Merged dimension (all versions).

    ``update`` closes the open version at ``now`` and inserts the new version (created = now);
    ``new_insert`` inserts open since ``190001010000``; ``exist_insert`` inserts created = now;
    equal rows do nothing (``ignore``, snapshot source) or close the open version (``close``,
    difference feed); with ``close_missing`` open versions of keys absent from the source close.

    The source must hold one row per key (identical copies collapse); otherwise, or with a NULL
    key unless ``null_safe_keys``, :class:`DuplicateKeyError` is raised.

    Columns that only the source has are added, NULL in older versions. They alone make no new version: if a
    row's hash over gold's own columns is unchanged, the open version takes the new values and hash in place.

    ``now`` before the start of a version that it would close is an error.
    """
    closed = gold.filter(~is_open_version())
    change = scd2_change(
        gold.filter(is_open_version()), source, closed, keys, now, on_same_hash, close_missing, null_safe_keys,
        check_source, num_partitions, max_sk,
    )
    return with_new_columns(closed, source).unionByName(change.all_rows())


def scd2_current(gold: DataFrame) -> DataFrame:
    """Open versions (one per key)."""
    return gold.filter(F.col(UPDATED_COL) == F.lit(OPEN_END))


def scd2_as_of(gold: DataFrame, when) -> DataFrame:
    """Versions valid at ``when``: ``created_date <= when < updated_date`` (half-open)."""
    w = to_stamp(when)
    return gold.filter((F.col(CREATED_COL) <= F.lit(w)) & (F.lit(w) < F.col(UPDATED_COL)))


def scd2_interval_join(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """Two type 2 dimensions connected in time: a row for every stretch in which a version of both is valid.

    ``on``: column of ``left`` -> key column of ``right``. A row has the columns of both (row hashes and the right
    keys left out) and the intersection of the validity ranges, ``[max(created), min(updated))``. If the versions of
    every key of both sides follow each other without gaps, so do the rows of every key of ``left`` whose reference
    is found. Versions of no length take no part.

    The join is on the keys, with the ranges as a condition; Spark broadcasts the smaller side or splits a hot key.
    """
    dates = {CREATED_COL, UPDATED_COL, HASH_COL}
    mine = [c for c in left.columns if c not in dates]
    theirs = [c for c in right.columns if c not in dates and c not in on.values()]
    both = set(mine) & set(theirs)
    if both:
        raise ValueError(f"both dimensions have columns {sorted(both)}")
    lasting = F.col(CREATED_COL) < F.col(UPDATED_COL)
    r = right.filter(lasting).select(
        *theirs, *[F.col(k).alias(f"_r_{k}") for k in on.values()], *[F.col(c).alias(f"_r_{c}") for c in (CREATED_COL, UPDATED_COL)]
    )
    cond = key_condition(list(on), [f"_r_{k}" for k in on.values()], False)
    cond = cond & (F.col(CREATED_COL) < F.col(f"_r_{UPDATED_COL}")) & (F.col(f"_r_{CREATED_COL}") < F.col(UPDATED_COL))
    return left.filter(lasting).join(r, cond).select(
        *mine,
        *theirs,
        F.greatest(CREATED_COL, f"_r_{CREATED_COL}").alias(CREATED_COL),
        F.least(UPDATED_COL, f"_r_{UPDATED_COL}").alias(UPDATED_COL),
    )


def scd2_history(gold: DataFrame) -> DataFrame:
    """All versions with ``valid_from`` / ``valid_to`` as ``timestamp_ntz`` and an ``is_current`` flag."""
    return gold.withColumns(
        {
            "valid_from": stamp_to_timestamp(F.col(CREATED_COL)),
            "valid_to": stamp_to_timestamp(F.col(UPDATED_COL)),
            "is_current": F.col(UPDATED_COL) == F.lit(OPEN_END),
        }
    )
