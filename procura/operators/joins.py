"""Join operators.

Design rules used throughout:

* Join sides carry disjoint column names (reports prefix every base column),
  so conditions are plain ``left[a] == right[b]`` without aliases.
* Outer joins whose key may be NULL spread the NULL-keyed rows over the
  cluster with a deterministic salt (a NULL key can never match, so where it
  lands does not change the result, only the balance). Without this every
  PO line that has no requisition, or every receipt-less row, would hash to
  the single partition of ``NULL``.
* Strict one-row lookups never collect anything: the dimension is grouped by
  key (partial aggregation first), joined, and a ``raise_error`` guard fires
  only for fact rows that actually meet a duplicated key — the same lazy
  failure a scalar subquery has.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from procura.functions.expr import effective_on
from procura.session import Steps, in_slice

_ids = itertools.count()

def _uid(prefix: str) -> str:
    return f"__{prefix}{next(_ids)}"


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _any_null(df: DataFrame, keys: Sequence[str]) -> Column:
    any_null = None
    for k in keys:
        c = df[f"`{k}`"].isNull()
        any_null = c if any_null is None else (any_null | c)
    return any_null


def _id_columns(df: DataFrame) -> list[str]:
    """Integral columns (ids, line numbers): the default salt basis. Hashing
    only these keeps every text/decimal/date column prunable upstream."""
    ids = [f.name for f in df.schema.fields if isinstance(f.dataType, (LongType, IntegerType, ShortType, ByteType))]
    return ids or list(df.columns)


def _salt(df: DataFrame, keys: Sequence[str], spread_by: Sequence[str] | None) -> Column:
    """Salt of a preserved side: 0 for a row that can match, a hash of the
    row's identity for a row with a NULL key (as many values as rows)."""
    basis = [df[f"`{c}`"] for c in (spread_by or _id_columns(df))]
    return F.when(_any_null(df, keys), F.xxhash64(*basis)).otherwise(F.lit(0).cast("bigint"))


def _zero_salt(df: DataFrame, keys: Sequence[str]) -> Column:
    """Salt of the non-preserved side: always 0.

    Written as ``pmod(hash(key), 1)`` rather than a literal (or a NULL test,
    which folds when the key is known non-NULL) so the optimizer cannot turn
    it into a constant, move it out of the join keys and leave the NULL-keyed
    rows of the other side unspread.
    """
    return F.pmod(F.xxhash64(*[df[f"`{k}`"] for k in keys]), F.lit(1))


def same(a: str, b: str) -> Column:
    """``a = b`` kept as a residual join condition (not a partitioning key):
    lets several joins share one partitioning key while still checking
    further columns."""
    return F.coalesce(F.col(a) == F.col(b), F.lit(False))


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str],
    how: str = "left",
    *,
    extra: Column | None = None,
    spread_nulls: bool = True,
    spread_by: Sequence[str] | None = None,
    spread_by_right: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join on ``left_keys == right_keys`` (plus optional residual
    ``extra``) for ``how`` in inner/left/full.

    For ``left``/``full`` joins rows with a NULL key on the preserved side(s)
    are salted so they spread across partitions instead of piling up in one
    task. ``spread_by`` / ``spread_by_right`` name the row-identifying
    columns hashed for the salt (default: the side's integral columns).
    """
    lk, rk = _as_list(left_keys), _as_list(right_keys)
    if len(lk) != len(rk):
        raise ValueError("key lists differ in length")
    cond = None
    for a, b in zip(lk, rk):
        c = left[f"`{a}`"] == right[f"`{b}`"]
        cond = c if cond is None else cond & c
    if spread_nulls and how in ("left", "left_outer", "full", "full_outer", "outer"):
        # the salts are extra join-key expressions (no helper columns)
        full = how in ("full", "full_outer", "outer")
        right_salt = _salt(right, rk, spread_by_right) if full else _zero_salt(right, rk)
        cond = cond & (_salt(left, lk, spread_by) == right_salt)
    if extra is not None:
        cond = cond & extra
    return left.join(right, cond, how)


def keyed_join_named(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_name: str,
    right_name: str,
    how: str = "left",
) -> DataFrame:
    """Join on ``left_key = right_key and (left_name = right_name or left_name
    is NULL)`` as one equi-join, without a residual ``OR``.

    The two cases are disjoint: a left row that names a right row meets it
    under (key, name), one that names none meets every right row of its key
    under (key, NULL). Each right row is put down under both (a row without a
    name under NULL only), so only matching pairs are ever compared: n left
    rows that name one of n right rows each of one key cost n, not n * n.
    """
    name = _uid("name")
    joined = keyed_join(left, by_name_and_all(right, right_name, name), left_key, right_key, how, extra=left[f"`{left_name}`"].eqNullSafe(F.col(name)))
    return joined.drop(name)


def by_name_and_all(df: DataFrame, name: str, out: str) -> DataFrame:
    """Every row of ``df`` once with its ``name`` and once with NULL in the column ``out`` (a NULL name: once)."""
    n = F.col(f"`{name}`")
    none = F.lit(None).cast(df.schema[name].dataType)
    return df.withColumn(out, F.explode(F.when(n.isNull(), F.array(none)).otherwise(F.array(n, none))))


#: Rows with a NULL key meet one of so many NULL stand-ins, chosen by a hash of the row.
NULL_STAND_INS = 4096


def _met(df: DataFrame, key: str, spread_by: Sequence[str] | None, first: int) -> Column:
    """Second join key: -1 for a row with a key, else the number, from ``first`` on, of the stand-in that it meets."""
    basis = [F.col(f"`{c}`") for c in (spread_by or _id_columns(df))]
    return F.when(F.col(f"`{key}`").isNull(), first + F.pmod(F.xxhash64(*basis), F.lit(NULL_STAND_INS))).otherwise(F.lit(-1).cast("bigint"))


def _null_stand_ins(df: DataFrame, met: str, first: int) -> DataFrame:
    return df.sparkSession.range(first, first + NULL_STAND_INS, 1, 1).select(F.col("id").alias(met))


def _own_exchange(key: str, salt: str) -> Column:
    """Always 0, yet part of the join key: the join gets an exchange of its
    own, so a neighbouring join on the same key does not forbid AQE to split
    a hot partition."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1))


def left_join_splittable(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    unmatched: DataFrame,
    told: Mapping[str, str],
    extra: Column | None = None,
    also: Mapping[str, str] | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left join written as one inner join, so that AQE can split a hot key on
    either side (an outer join cannot be split on its nullable side).

    ``unmatched`` holds, in the columns ``told`` names (left column -> column
    of ``unmatched``), one distinct row per combination of left values that
    no right row matches. It comes from a narrow plan, and its rows join the
    right side as placeholders: a left row meets either its matches or its
    placeholder, whose right columns are NULL. A left row with a NULL key
    meets one of ``NULL_STAND_INS`` placeholders that stand for no key.
    ``also`` names further key columns (left column, which must be told, ->
    right column) that are equal or both NULL. The join has an exchange of its
    own (``_own_exchange``).
    """
    also = dict(also or {})
    flag, own = _uid("ph"), {c: _uid("k") for c in told}
    key, met, left_met = _uid("j"), _uid("m"), _uid("m")
    further = {c: _uid("j") for c in also}
    stand_in = unmatched.where(F.col(told[left_key]).isNotNull()).select(
        *[F.col(u).alias(own[c]) for c, u in told.items()], F.col(told[left_key]).alias(key),
        *[F.col(told[c]).alias(f) for c, f in further.items()], F.lit(-1).cast("bigint").alias(met), F.lit(1).alias(flag),
    )
    ext = right.where(F.col(f"`{right_key}`").isNotNull()).select(
        "*", F.col(f"`{right_key}`").alias(key),
        *[F.col(f"`{also[c]}`").alias(f) for c, f in further.items()], F.lit(-1).cast("bigint").alias(met), F.lit(0).alias(flag),
    )
    ext = ext.unionByName(stand_in, allowMissingColumns=True)
    ext = ext.unionByName(_null_stand_ins(left, met, 0).withColumn(flag, F.lit(2)), allowMissingColumns=True)
    no_key = F.col(f"`{left_key}`").isNull()
    asked = {c: _uid("j") for c in also}
    side = left.select("*", _met(left, left_key, spread_by, 0).alias(left_met),
                       *[F.when(~no_key, F.col(f"`{c}`")).alias(a) for c, a in asked.items()])
    same_row = F.col(flag) == 1
    for c, k in own.items():
        same_row = same_row & F.col(f"`{c}`").eqNullSafe(F.col(k))
    match = F.col(flag) == 0 if extra is None else ((F.col(flag) == 0) & extra)
    cond = F.col(f"`{left_key}`").eqNullSafe(F.col(key)) & (F.col(left_met) == F.col(met)) & (_own_exchange(f"`{left_key}`", key) == _own_exchange(key, key))
    for c, f in further.items():
        cond = cond & F.col(asked[c]).eqNullSafe(F.col(f))
    cond = cond & ((F.col(flag) == 2) | same_row | match)
    return side.join(ext, cond, "inner").drop(key, met, left_met, flag, *own.values(), *further.values(), *asked.values())


def _guard(col: Column, cnt: str, what: str) -> Column:
    return F.when(F.col(cnt) > 1, F.raise_error(F.lit(f"more than one row in lookup {what}"))).otherwise(col)


def scalar_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_keys: str | Sequence[str],
    dim_keys: str | Sequence[str],
    cols: Mapping[str, str | Column],
    *,
    strict: bool = True,
    name: str = "lookup",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Attach a one-row-per-key lookup to ``fact`` (scalar subquery semantics).

    ``cols`` maps output name -> dimension column/expression. No matching row
    gives NULL; with ``strict`` more than one matching row raises, but only
    for fact rows that meet such a key (evaluation is lazy per row).
    """
    fk, dk = _as_list(fact_keys), _as_list(dim_keys)
    cnt = _uid("n")
    tmp = {out: _uid("v") for out in cols}
    gk = [_uid("k") for _ in dk]
    grouped = dim.select(*[F.col(d).alias(g) for d, g in zip(dk, gk)], *[
        (F.col(s) if isinstance(s, str) else s).alias(tmp[o]) for o, s in cols.items()
    ]).groupBy(*gk).agg(F.count(F.lit(1)).alias(cnt), *[F.any_value(tmp[o]).alias(tmp[o]) for o in cols])
    joined = keyed_join(fact, grouped, fk, gk, "left", spread_by=spread_by)
    outs = []
    for out in cols:
        v = F.col(tmp[out])
        outs.append((_guard(v, cnt, name) if strict else v).alias(out))
    return joined.select(*fact.columns, *outs)


def dated_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_keys: str | Sequence[str],
    dim_keys: str | Sequence[str],
    at: Column,
    start: str,
    end: str,
    how: str = "left",
    **kw,
) -> DataFrame:
    """Join ``dim`` rows valid at the fixed instant ``at`` (inclusive bounds).

    The date test restricts the dimension *before* the join, so in a left
    join a fact row whose key exists but is not valid at ``at`` is kept with
    NULLs (not dropped).
    """
    active = dim.where(effective_on(at, start, end))
    return keyed_join(fact, active, fact_keys, dim_keys, how, **kw)


def dated_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_at: str,
    start: str,
    end: str,
    cols: Mapping[str, str],
    *,
    strict: bool = True,
    name: str = "dated lookup",
) -> DataFrame:
    """Per-row as-of lookup: the ``dim`` row for ``fact_key`` valid at the
    fact row's own date ``fact_at`` (inclusive bounds; dates or timestamps).

    A merge by date: the opening and the closing of every version and the
    distinct (key, date) pairs of the fact side are ordered within their key,
    and running sums tell how many versions are open at a pair and, where it
    is one, which. n versions and m days of a key cost (n + m) log (n + m)
    instead of n * m comparisons. More than one open version raises if
    ``strict``; otherwise the value of one of them is taken, found by the date
    range for those pairs alone. A version with a NULL bound, or that ends
    before it starts, is never valid; a NULL key or date finds nothing.
    """
    k, d = _uid("k"), _uid("d")
    probe = fact.select(F.col(fact_key).alias(k), F.col(fact_at).alias(d)).where(
        F.col(k).isNotNull() & F.col(d).isNotNull()
    ).distinct()
    vals = {o: _uid("v") for o in cols}
    cnt, which = _uid("n"), _uid("w")
    dim_sel = dim.select(
        F.col(dim_key).alias("__dk"), F.col(start).alias("__ds"), F.col(end).alias("__de"),
        *[F.col(s).alias(vals[o]) for o, s in cols.items()],
    ).where(F.col("__dk").isNotNull() & (F.col("__ds") <= F.col("__de")))
    # versions of equal bounds are open together or not at all, so their order never shows
    numbered = dim_sel.withColumn("__no", F.row_number().over(Window.partitionBy("__dk").orderBy("__ds", "__de")).cast("bigint"))

    def mark(at: Column, turn: int, open_: int, no: Column) -> Column:
        return F.struct(at.alias(d), F.lit(turn).alias("__turn"), F.lit(open_).cast("bigint").alias("__open"), no.alias("__no"))

    marks = numbered.select(F.col("__dk").alias(k), F.explode(F.array(
        mark(F.col("__ds"), 0, 1, F.col("__no")), mark(F.col("__de"), 2, -1, -F.col("__no")))).alias("__m")).select(k, "__m.*")
    days = probe.select(k, d, F.lit(1).alias("__turn"), F.lit(0).cast("bigint").alias("__open"), F.lit(0).cast("bigint").alias("__no"))
    so_far = Window.partitionBy(k).orderBy(d, "__turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = marks.unionByName(days).select(k, d, "__turn", F.sum("__open").over(so_far).alias(cnt), F.sum("__no").over(so_far).alias(which))
    placed = placed.where((F.col("__turn") == 1) & (F.col(cnt) > 0)).drop("__turn")
    version = numbered.select("__dk", F.col("__no").alias("__version"), *vals.values())
    single = placed if strict else placed.where(F.col(cnt) == 1)
    matched = single.join(version, (F.col(k) == F.col("__dk")) & (F.col(which) == F.col("__version")), "left").select(k, d, cnt, *vals.values())
    if not strict:
        several = placed.where(F.col(cnt) > 1).join(dim_sel, (F.col(k) == F.col("__dk")) & effective_on(d, "__ds", "__de"))
        matched = matched.unionByName(several.groupBy(k, d, cnt).agg(*[F.any_value(v).alias(v) for v in vals.values()]))
    joined = keyed_join(fact, matched, [fact_key, fact_at], [k, d], "left")
    outs = [(_guard(F.col(vals[o]), cnt, name) if strict else F.col(vals[o])).alias(o) for o in cols]
    return joined.select(*fact.columns, *outs)


def _key_values(df: DataFrame, key: str, keys: DataFrame | None, out: str) -> DataFrame:
    src = df.select(F.col(f"`{key}`").alias(out)) if keys is None else keys.select(F.col(f"`{keys.columns[0]}`").alias(out))
    return src.where(F.col(out).isNotNull()).distinct()


def full_outer(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    spread_left: Sequence[str] | None = None,
    spread_right: Sequence[str] | None = None,
    left_keys: DataFrame | None = None,
    right_keys: DataFrame | None = None,
    reread: bool = False,
) -> DataFrame:
    """Full outer equi-join written as one inner join, so that AQE can split a
    hot key on either side (a FULL join cannot be split at all).

    Each side gets placeholders, rows with NULL in all its columns, for the
    other side's keys that it does not hold. A row meets either its matches or
    its placeholder, never both. Rows with a NULL key, which match nothing,
    meet placeholders of their own that a hash of the row chooses
    (``NULL_STAND_INS``), so they spread over the cluster.

    The keys come from narrow plans: the side's key column alone (column
    pruning keeps that branch narrow), or ``left_keys`` / ``right_keys``,
    one-column frames that hold exactly the side's key values, from cheaper
    plans. They are made distinct map-side, so a hot key is one row there.

    ``reread`` is for sides that are cheap to read twice (stored ones): rows
    with a NULL key are then not moved at all, but put beside the join.
    """
    if reread:
        def part(df: DataFrame, key: str, known: bool) -> DataFrame:
            k = F.col(f"`{key}`")
            return df.where(k.isNotNull() if known else k.isNull())

        joined = full_outer(part(left, left_key, True), part(right, right_key, True), left_key, right_key, spread_left=spread_left,
                            spread_right=spread_right, left_keys=left_keys, right_keys=right_keys)
        for df, key in ((left, left_key), (right, right_key)):
            joined = joined.unionByName(part(df, key, False), allowMissingColumns=True)
        return joined
    lk, rk = _uid("fk"), _uid("fk")
    l_keys, r_keys = _key_values(left, left_key, left_keys, lk), _key_values(right, right_key, right_keys, rk)

    def side(df: DataFrame, key: str, spread: Sequence[str] | None, first: int, missing: DataFrame, other_first: int) -> tuple[DataFrame, str, str]:
        j, met = _uid("j"), _uid("m")
        rows = df.select("*", F.col(f"`{key}`").alias(j), _met(df, key, spread, first).alias(met))
        stand_in = missing.select(F.col(missing.columns[0]).alias(j), F.lit(-1).cast("bigint").alias(met))
        rows = rows.unionByName(stand_in, allowMissingColumns=True)
        return rows.unionByName(_null_stand_ins(df, met, other_first), allowMissingColumns=True), j, met

    only_right = r_keys.join(l_keys, F.col(rk) == F.col(lk), "left_anti")
    only_left = l_keys.join(r_keys, F.col(lk) == F.col(rk), "left_anti")
    l_side, lj, lm = side(left, left_key, spread_left, 0, only_right, NULL_STAND_INS)
    r_side, rj, rm = side(right, right_key, spread_right, NULL_STAND_INS, only_left, 0)
    cond = F.col(lj).eqNullSafe(F.col(rj)) & (F.col(lm) == F.col(rm)) & (_own_exchange(lj, lj) == _own_exchange(rj, lj))
    return l_side.join(r_side, cond, "inner").drop(lj, lm, rj, rm)


def lineage_chain(
    po: DataFrame,
    pr: DataFrame,
    rfq: DataFrame | None,
    po_key: str,
    pr_key: str,
    rfq_key: str | None = None,
    *,
    po_spread: Sequence[str] | None = None,
    pr_spread: Sequence[str] | None = None,
    rfq_spread: Sequence[str] | None = None,
    po_keys: DataFrame | None = None,
    pr_keys: DataFrame | None = None,
    rfq_keys: DataFrame | None = None,
) -> DataFrame:
    """``(po ⟗ pr) ⟗ rfq`` where the second join is keyed on the **PR**
    side's key only (not coalesced): PO-only rows never meet an RFQ and RFQs
    whose requisition line is outside the PR block surface as RFQ-only rows.

    Evaluated as ``po ⟗ (rfq ⟗ pr)``: both predicates are NULL-rejecting
    equalities and the second references only PR and RFQ columns, so the
    full joins associate. The narrow PR and RFQ rows meet first and the wide
    order rows are shuffled once. A hot key can be split on any side (many
    orders or RFQ lines per requisition distribution). ``*_keys`` are narrow
    plans of the sides' key values, as in ``full_outer``.
    """
    if rfq is not None:
        pr = full_outer(rfq, pr, rfq_key or pr_key, pr_key, spread_left=rfq_spread, spread_right=pr_spread, left_keys=rfq_keys, right_keys=pr_keys)
        pr_spread = None if pr_spread is None else list(pr_spread) + ([rfq_key] if rfq_key else [])
    return full_outer(po, pr, po_key, pr_key, spread_left=po_spread, spread_right=pr_spread, left_keys=po_keys, right_keys=pr_keys)


def lineage_parts(po: DataFrame, pr: DataFrame, rfq: DataFrame | None, po_key: str, pr_key: str, rfq_key: str | None, keep: Steps) -> Iterator[DataFrame]:
    """``lineage_chain`` of sides that are stored, as frames that hold its rows by slices of the requisition's key.

    The PR side is stored by ``keep`` before the first frame; every frame
    reads its keys from both sides and does not move rows without a key."""
    if rfq is not None:
        pr = full_outer(rfq, pr, rfq_key or pr_key, pr_key, reread=True)
    pr = keep(pr, "requisitions")
    n = keep.slices()
    for i in range(n):
        yield full_outer(po.where(in_slice(po_key, i, n)), pr.where(in_slice(pr_key, i, n)), po_key, pr_key, reread=True)


def semi_in(df: DataFrame, other: DataFrame, keys: str | Sequence[str], other_keys: str | Sequence[str] | None = None) -> DataFrame:
    """``key IN (select ...)``: left-semi join (duplicates in ``other`` never multiply)."""
    k = _as_list(keys)
    ok = _as_list(other_keys) if other_keys is not None else k
    cond = None
    for a, b in zip(k, ok):
        c = df[a] == other[b]
        cond = c if cond is None else cond & c
    return df.join(other, cond, "left_semi")


def anti_exists(df: DataFrame, other: DataFrame, keys: str | Sequence[str], other_keys: str | Sequence[str] | None = None) -> DataFrame:
    """``NOT EXISTS (select 1 ... where other.key = df.key)``: left-anti join.
    Rows with a NULL key are kept (they match nothing)."""
    k = _as_list(keys)
    ok = _as_list(other_keys) if other_keys is not None else k
    cond = None
    for a, b in zip(k, ok):
        c = df[a] == other[b]
        cond = c if cond is None else cond & c
    return df.join(other, cond, "left_anti")
