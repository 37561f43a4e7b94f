"""Join planning for variant-level and gene-level annotation.

Three shapes cover every join of the reference:

* ``left_join_lookup`` - a (possibly huge, possibly skewed) left table joined
  to a lookup table on equal keys.  The lookup is broadcast only when a
  count proves it small; otherwise both sides are shuffled and keys
  that carry many left rows are salted so no task receives a hot key whole.
* ``annotate_by_key`` - many left joins on the four-column variant key.  A
  bounded variant table is annotated against annotation tables reduced to its
  keys by a broadcast semi-join (the genome-wide tables are filtered
  map-side and never shuffled).  An unbounded table is first reduced to its
  distinct keys (map-side combined, so a hot key costs one row per task), the
  keys are annotated with one shuffle per annotation table, and the result is
  joined back with ``left_join_lookup``.
* ``left_join_any`` - a left join whose condition is an OR of equalities,
  planned as the union of equi-joins over the distinct key pairs instead of a
  nested-loop join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.config import DEFAULT_LIMITS, Limits, written
from varlake.functions.keys import KEY
from varlake.operators.sketches import key_sketch, maybe_among

SALT = "__salt"
SALTS = "__n_salt"
ROWS = "__rows"
# Sub-keys for rows without a key, and the bound from which no key is hot.
NULL_SALTS = 1 << 20
NEVER_HOT = 1 << 62


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row of ``df`` takes in memory."""
    total = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            total = total + 32 + F.coalesce(
                16 * F.size(c) + F.octet_length(F.array_join(c, "")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            total = total + 32 + F.coalesce(2 * F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            total = total + 8
    return total.cast("long")


def measured(frames: Mapping[str, DataFrame],
             most_rows: Mapping[str, int] | None = None) -> dict[str, tuple[int, int]]:
    """(rows, bytes) of several frames in one Spark job.  Every task ships one
    sum per frame; no row leaves its task.

    Of a frame with more than ``most_rows`` rows, which are counted first, the bytes
    aren't measured: the least that such rows take (16 bytes each) is given."""
    if not frames:
        return {}
    if most_rows:
        rows = {name: n for name, (n, _) in _sums(
            {name: df for name, df in frames.items() if name in most_rows}, lambda df: F.lit(0)).items()}
        many = {name: (n, 16 * n) for name, n in rows.items() if n > most_rows[name]}
        return {**many, **measured({name: df for name, df in frames.items() if name not in many})}
    return _sums(frames, _row_bytes)


def _sums(frames: Mapping[str, DataFrame], of: Callable[[DataFrame], Column]) -> dict[str, tuple[int, int]]:
    """Rows of several frames and the sums of ``of`` over them, in one job."""
    parts = [
        df.select(of(df).alias("bytes")).groupBy()
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        .select(F.lit(name).alias("name"), "rows", "bytes")
        for name, df in frames.items()
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return {r["name"]: (r["rows"], r["bytes"]) for r in union.collect()}


def rows_at_most(frames: Mapping[str, DataFrame], n: int,
                 limits_by_name: Mapping[str, int] | None = None, *,
                 max_bytes: int = DEFAULT_LIMITS.max_broadcast_bytes,
                 bytes_by_name: Mapping[str, int] | None = None) -> dict[str, bool]:
    """For each name (see :func:`measured`) whether that frame has at most
    ``n`` rows and ``max_bytes`` bytes (or its own bounds from
    ``limits_by_name`` and ``bytes_by_name``)."""
    return {
        name: rows <= (limits_by_name or {}).get(name, n)
        and size <= (bytes_by_name or {}).get(name, max_bytes)
        for name, (rows, size) in measured(frames).items()
    }


def broadcast_choice(sizes: Mapping[str, tuple[int, int]], limits: Limits, *, reserved: int = 0,
                     copies: Mapping[str, int] | None = None) -> dict[str, bool]:
    """Which tables of one pipeline to broadcast, by their measured (rows, bytes).

    Each must be within the bounds for one table, and all together, with
    ``reserved`` bytes that are broadcast anyway and ``copies`` of a table counted
    as often, within ``limits.max_total_broadcast_bytes``.  A broadcast saves the
    same shuffle (of the left side) for every table, so the smallest come first.
    """
    left = limits.max_total_broadcast_bytes - reserved
    chosen = dict.fromkeys(sizes, False)
    cost = {name: size * (copies or {}).get(name, 1) for name, (_, size) in sizes.items()}
    for name in sorted(sizes, key=lambda n: (cost[n], n)):
        rows, size = sizes[name]
        if rows <= limits.max_broadcast_rows and size <= limits.max_broadcast_bytes and cost[name] <= left:
            chosen[name] = True
            left -= cost[name]
    return chosen


def row_count_at_most(df: DataFrame, n: int, max_bytes: int = DEFAULT_LIMITS.max_broadcast_bytes
                      ) -> bool:
    """Whether ``df`` has at most ``n`` rows and ``max_bytes`` bytes."""
    return rows_at_most({"df": df}, n, max_bytes=max_bytes)["df"]


def checked_broadcast(df: DataFrame, limits: Limits) -> DataFrame | None:
    """``broadcast(df)`` if a count proves ``df`` small, else None."""
    if row_count_at_most(df, limits.max_broadcast_rows, limits.max_broadcast_bytes):
        return F.broadcast(df)
    return None


def _row_hash(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """Deterministic per-row hash (recomputes identically after a lost task)."""
    cols = [F.col(f"`{c}`") for c in df.columns if c not in exclude]
    return F.xxhash64(*cols)


def _eq(left: DataFrame, right: DataFrame, pairs, null_safe: bool) -> Column:
    cond = None
    for lk, rk in pairs:
        term = (
            left[lk].eqNullSafe(right[rk]) if null_safe else left[lk] == right[rk]
        )
        cond = term if cond is None else cond & term
    return cond


def left_join_lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    *,
    null_safe: bool = False,
    keep_right_keys: bool = False,
    try_broadcast: bool = True,
    right_is_small: bool | None = None,
    left_counts: DataFrame | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Left join ``left`` to ``right`` on equal keys, skew-safe.

    ``on`` is a list of column names present on both sides, or a mapping
    ``{left_name: right_name}``.  Output: every left column, then every right
    column except the right keys (unless ``keep_right_keys``).  Left rows
    without a match are kept once with NULLs; a match with several right rows
    repeats the left row (plain left-join semantics).

    Rows of ``left`` that are equal in every column share a sub-key.

    ``try_broadcast=False`` skips the count (for a right side known to
    be large, or one whose count would re-run the left's whole plan);
    ``right_is_small`` passes the result of a count made earlier
    (see :func:`rows_at_most`); ``left_counts`` (left keys + ``__rows``)
    reuses a per-key count the caller already has.
    """
    pairs = list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]
    right_keys = [rk for _, rk in pairs]
    # Rename the right side so its columns cannot collide with the left's.
    r_alias = {c: f"__r_{i}" for i, c in enumerate(right.columns)}
    r = right.select([F.col(f"`{c}`").alias(r_alias[c]) for c in right.columns])
    rpairs = [(lk, r_alias[rk]) for lk, rk in pairs]
    out_right = [
        c for c in right.columns if keep_right_keys or c not in set(right_keys)
    ]
    if keep_right_keys:
        # A right key with the same name as a left column keeps the left one.
        out_right = [c for c in out_right if c not in set(left.columns)]

    if right_is_small is not None:
        small = F.broadcast(r) if right_is_small else None
    else:
        small = checked_broadcast(r, limits) if try_broadcast else None
    if small is not None:
        joined = left.join(small, _eq(left, small, rpairs, null_safe), "left")
        return joined.select(
            [left[f"`{c}`"] for c in left.columns]
            + [F.col(r_alias[c]).alias(c) for c in out_right]
        )

    # Shuffle join.  Hot keys get several sub-keys, rows without a key get one
    # each (they match nothing), and ``left`` enters the plan once.
    lkeys = [lk for lk, _ in rpairs]
    hot = _hot_keys(left, lkeys, left_counts, limits)
    salted_left = _salted(left, lkeys, hot, null_safe)
    salted_right = _replicated(r, [rk for _, rk in rpairs], lkeys, hot, null_safe, "__rsalt")
    cond = _eq(salted_left, salted_right, rpairs, null_safe) & (
        salted_left[SALT] == salted_right["__rsalt"]
    )
    joined = salted_left.join(salted_right, cond, "left")
    return joined.select(
        [salted_left[f"`{c}`"] for c in left.columns]
        + [F.col(r_alias[c]).alias(c) for c in out_right]
    )


def left_join_in_bins(left: DataFrame, right: DataFrame, on: Sequence[str], bin_column: str, *,
                      null_safe: bool = False) -> DataFrame:
    """Left join ``left`` to ``right`` on equal ``on`` columns, where both have been dealt to
    the same partitions by ``bin_column`` (``repartitionById``; every right row is in all
    bins that have left rows of its key): neither is shuffled.  No bin is much larger than
    others, so keys need no sub-keys.  Output as :func:`left_join_lookup`."""
    renamed = {c: f"__r_{i}" for i, c in enumerate(right.columns)}
    r = right.withColumnsRenamed(renamed)
    cond = (left[bin_column] == r[renamed[bin_column]]) & _eq(
        left, r, [(c, renamed[c]) for c in on], null_safe)
    return left.join(r, cond, "left").select(
        *[left[f"`{c}`"] for c in left.columns],
        *[F.col(renamed[c]).alias(c) for c in right.columns if c not in (*on, bin_column)])


def _salted(left: DataFrame, keys: Sequence[str], hot: DataFrame | None,
            null_safe: bool) -> DataFrame:
    """``left`` plus ``SALT``: which of its key's sub-keys a row has.  Rows
    without a key match nothing (unless ``null_safe``) and have one each."""
    marked, salt = left, F.lit(1)
    if hot is not None:
        h = F.broadcast(hot.select(
            [F.col(f"`{k}`").alias(f"__h_{i}") for i, k in enumerate(keys)] + [SALTS]))
        marked = left.join(
            h, _eq(left, h, [(k, f"__h_{i}") for i, k in enumerate(keys)], null_safe), "left")
        salt = F.coalesce(F.col(SALTS), F.lit(1))
    if not null_safe:
        no_key = F.lit(False)
        for k in keys:
            no_key = no_key | F.col(f"`{k}`").isNull()
        salt = F.when(no_key, F.lit(NULL_SALTS)).otherwise(salt)
    return marked.select(*[F.col(f"`{c}`") for c in left.columns],
                         F.pmod(_row_hash(left), salt).cast("int").alias(SALT))


def _replicated(right: DataFrame, keys: Sequence[str], hot_keys: Sequence[str],
                hot: DataFrame | None, null_safe: bool, name: str) -> DataFrame:
    """``right`` with ``name``: a copy of its row for every sub-key of its key
    (columns ``keys``, as ``hot_keys`` in ``hot``)."""
    if hot is None:
        # Always 0, but not a constant: a constant would leave the join's hash
        # keys, and all rows without a key would meet in one task.
        return right.withColumn(name, F.pmod(
            F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(1)).cast("int"))
    h = F.broadcast(hot.select(
        [F.col(f"`{k}`").alias(f"__g_{i}") for i, k in enumerate(hot_keys)]
        + [F.col(SALTS).alias("__rs")]))
    return right.join(
        h, _eq(right, h, [(k, f"__g_{i}") for i, k in enumerate(keys)], null_safe), "left"
    ).select(
        *[F.col(f"`{c}`") for c in right.columns],
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__rs"), F.lit(1)) - 1)).alias(name))


def _hot_keys(left: DataFrame, keys: Sequence[str], counts: DataFrame | None,
              limits: Limits) -> DataFrame | None:
    """The keys of ``left`` with over ``hot_key_rows`` rows, and into how many
    sub-keys each is split; None if there are none.  Keys are counted by a
    map-side combined aggregate, and fewer than rows / ``hot_key_rows`` of
    them come to the driver, so the plan holds neither ``left`` nor the count
    again."""
    if limits.hot_key_rows >= NEVER_HOT:
        return None
    if counts is None:
        counts = left.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(ROWS))
    hot = (
        counts.where(F.col(ROWS) > limits.hot_key_rows)
        .select(*[F.col(f"`{k}`") for k in keys],
                F.ceil(F.col(ROWS) / F.lit(limits.hot_key_rows)).cast("int").alias(SALTS))
    )
    found = hot.collect()
    return left.sparkSession.createDataFrame(found, hot.schema) if found else None


def project_annotation(
    table: DataFrame,
    columns: Sequence[str] | Mapping[str, str],
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Key columns plus the wanted value columns, renamed if a mapping
    ``{source: target}`` is given; ``start`` as bigint for the key join."""
    if isinstance(columns, Mapping):
        values = [F.col(f"`{s}`").alias(t) for s, t in columns.items()]
    else:
        values = [F.col(f"`{c}`") for c in columns]
    keys = [F.col(k).cast("bigint").alias(k) if k == "start" else F.col(k) for k in key]
    return table.select(*keys, *values)


@dataclass(frozen=True)
class Derived:
    """A key table still to be made from ``source``: ``finish`` aggregates it
    per key, so restricting the source to some keys first changes nothing."""

    source: DataFrame
    finish: Callable[[DataFrame], DataFrame]


def annotate_by_key(
    variants: DataFrame,
    tables: Sequence[DataFrame | Derived],
    *,
    key: Sequence[str] = KEY,
    strategy: str = "auto",
    variants_bounded: bool | None = None,
    variant_rows: int | None = None,
    distinct_tables: bool = False,
    sketch: bool = True,
    counted: DataFrame | None = None,
    counts: DataFrame | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Left-join every table in ``tables`` (key + value columns) to
    ``variants`` on ``key``, in order.  Results equal the chain of plain left
    joins; ``strategy`` only changes the physical plan:

    ``'reduce'`` - broadcast the (proven small) distinct variant keys, semi-join
    each annotation table to them map-side, then join the reduced tables.
    ``'keys'`` - annotate the distinct keys with one shuffle per table and join
    the annotated keys back skew-safely.  With ``sketch`` the tables lose most
    rows of other keys before that shuffle (:mod:`varlake.operators.sketches`),
    unless a sketch of the keys is larger than ``limits.max_sketch_bytes``.
    ``'auto'`` - ``'reduce'`` when ``variants`` is within
    ``limits.max_variant_rows`` and ``max_variant_bytes``, else ``'keys'``.

    ``variant_rows`` is a known bound on the rows of ``variants``: up to
    ``hot_key_rows`` no key can be hot, and none is looked for.
    ``distinct_tables`` drops repeated rows of each (reduced) table first.
    ``counted`` has the keys of ``variants``, each in as many rows or more, and is
    cheaper to work out: keys are counted there; or ``counts`` has them counted
    (:func:`key_counts`).
    """
    key = list(key)
    counted = variants if counted is None else counted
    if not tables:
        return variants
    if strategy == "auto":
        bounded = variants_bounded
        if bounded is None:
            variant_rows, size = measured({"keys": variants.select(*key)})["keys"]
            bounded = variant_rows <= limits.max_variant_rows and size <= limits.max_variant_bytes
        strategy = "reduce" if bounded else "keys"

    if strategy == "reduce":
        keys = F.broadcast(variants.select(*key).distinct())
        # Salted once: consecutive joins on (key, salt) keep one partitioning.
        cold = variant_rows is not None and variant_rows <= limits.hot_key_rows
        hot = None if cold else _hot_keys(counted, key, None, limits)
        out = _salted(variants, key, hot, null_safe=False)
        for t in tables:
            if isinstance(t, Derived):
                reduced = t.finish(t.source.join(keys, key, "left_semi"))
            else:
                reduced = t.join(keys, key, "left_semi")
            reduced = _replicated(_once(reduced, distinct_tables), key, key, hot, False, SALT)
            out = out.join(reduced, [*key, SALT], "left")
        return out.drop(SALT)
    if strategy == "keys":
        # One map-side combined count per key serves both as the distinct
        # keys to annotate and as the hot-key statistics of the join back.
        counts = key_counts(counted, key) if counts is None else counts
        annotated = annotated_keys(counts, tables, key=key, distinct_tables=distinct_tables,
                                   sketch=sketch, limits=limits)
        # The annotated keys are at least as many as the distinct keys of an
        # unbounded table: no broadcast, salted shuffle join.
        return left_join_lookup(
            variants, annotated, key, try_broadcast=False, left_counts=counts, limits=limits
        )

    if strategy == "plain":
        out = variants
        for t in tables:
            out = out.join(_finished(t, distinct_tables), key, "left")
        return out
    raise ValueError(f"unknown strategy {strategy!r}")


def key_counts(variants: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The distinct keys of ``variants`` and the rows that each has (``ROWS``), written."""
    return written(variants.groupBy(*key).agg(F.count(F.lit(1)).alias(ROWS)))


def annotated_keys(counts: DataFrame, tables: Sequence[DataFrame | Derived], *,
                   key: Sequence[str] = KEY, distinct_tables: bool = False, sketch: bool = True,
                   limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """The keys of ``counts`` (:func:`key_counts`) left-joined to every table in ``tables``,
    one shuffle each; the ``'keys'`` strategy of :func:`annotate_by_key`."""
    key = list(key)
    among = key_sketch(counts.select(*key), key, limits.max_sketch_bytes) if sketch else None
    annotated = counts.select(*key)
    for t in tables:
        annotated = annotated.join(_finished(t, distinct_tables, lambda d: d if among is None
                                             else maybe_among(d, key, among)), key, "left")
    return annotated


def _finished(table: DataFrame | Derived, distinct: bool,
              probed: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """A key table as it is joined, made from the rows that ``probed`` leaves."""
    return _once(table.finish(probed(table.source)) if isinstance(table, Derived) else probed(table),
                 distinct)


def _once(table: DataFrame, distinct: bool) -> DataFrame:
    return table.distinct() if distinct else table


def left_join_any(
    left: DataFrame,
    right: DataFrame,
    alternatives: Sequence[tuple[str, str]],
    right_unique: str,
    *,
    right_is_small: bool | None = None,
    split_keys: bool = False,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """``left LEFT JOIN right ON l1 = r1 OR l2 = r2 OR ...``.

    ``alternatives`` are ``(left_column, right_column)`` pairs; ``right_unique``
    names a column that identifies a right row.  A right row that matches by
    several alternatives appears once; a left row without any match is kept
    once with NULLs.  With ``split_keys`` a right key is a comma-joined list
    and matches by any of its elements.  Never a nested-loop join:

    * right proven small (count): per alternative, the right rows are
      grouped by that key into an array and broadcast; each left row takes the
      union of its arrays and explodes it - map-side, the left is not shuffled.
      With ``split_keys`` the arrays hold ``right_unique`` only, and the right is
      joined to it after that: a row of n ids is broadcast once, not n times
      with all its ids.  The single ids are counted, too.
    * otherwise: the distinct tuples of left keys are matched by one equi-join
      per alternative, the matches are united and de-duplicated per (tuple,
      right row) and joined back on the tuple with NULL-safe equality (salted).
    """
    lcols = list(dict.fromkeys(lk for lk, _ in alternatives))
    # What a match carries: with split keys the right row's name alone.
    carried = [right_unique] if split_keys else right.columns
    packed = F.struct(*[F.col(f"`{c}`") for c in carried])
    if split_keys:
        right = written(right)  # counted, split by each key and joined
    small = right_is_small
    if small is None:
        frames = {"right": right}
        if split_keys:
            frames |= {f"ids{i}": right.select(_key_of(rk, True), right_unique)
                       for i, (_, rk) in enumerate(alternatives)}
        small = all(rows_at_most(frames, limits.max_broadcast_rows,
                                 max_bytes=limits.max_broadcast_bytes).values())
    if small:
        out = left
        arrays = []
        for i, (lk, rk) in enumerate(alternatives):
            lut = (
                right.select(_key_of(rk, split_keys).alias(f"__lk{i}"), packed.alias("__row"))
                .where(F.col(f"__lk{i}").isNotNull())
                .groupBy(f"__lk{i}").agg(F.collect_list("__row").alias(f"__m{i}"))
            )
            lut = F.broadcast(lut)  # at most as many rows as ``right`` has (single) ids
            out = out.join(lut, out[lk] == lut[f"__lk{i}"], "left").drop(f"__lk{i}")
            arrays.append(f"__m{i}")
        empty = F.array().cast(T.ArrayType(packed_type(right.select(*[F.col(f"`{c}`") for c in carried]))))
        merged = F.coalesce(F.col(arrays[0]), empty)
        for a in arrays[1:]:
            merged = F.array_union(merged, F.coalesce(F.col(a), empty))
        out = out.select(
            *[F.col(f"`{c}`") for c in left.columns], F.explode_outer(merged).alias("__r")
        )
        if split_keys:
            # Equal structs: a right row whose name is NULL is found, no match isn't one.
            return left_join_lookup(out, right.withColumn("__named", packed), {"__r": "__named"},
                                    right_is_small=True, limits=limits).drop("__r")
        return out.select(
            *[F.col(f"`{c}`") for c in left.columns],
            *[F.col("__r").getField(c).alias(c) for c in right.columns],
        )

    tuples = left.select(*lcols).distinct()
    tag = {c: f"__k_{i}" for i, c in enumerate(lcols)}
    matches = None
    for lk, rk in alternatives:
        t = tuples.where(F.col(lk).isNotNull()).select(
            [F.col(c).alias(tag[c]) for c in lcols]
        )
        keyed = right.select(_key_of(rk, split_keys).alias("__rk"), *[
            F.col(f"`{c}`") for c in carried])
        m = t.join(keyed, t[tag[lk]] == keyed["__rk"], "inner").select(
            [t[tag[c]] for c in lcols] + [keyed[f"`{c}`"] for c in carried]
        )
        matches = m if matches is None else matches.unionByName(m)
    matches = matches.dropDuplicates([tag[c] for c in lcols] + [right_unique])
    if split_keys:
        matches = left_join_lookup(
            matches.select(*tag.values(), packed.alias("__r")), right.withColumn("__named", packed),
            {"__r": "__named"}, limits=limits).drop("__r")
    return left_join_lookup(
        left,
        matches,
        {c: tag[c] for c in lcols},
        null_safe=True,
        try_broadcast=False,
        limits=limits,
    )


def _key_of(column: str, split: bool) -> Column:
    return F.explode(F.split(column, ",")) if split else F.col(column)


def packed_type(df: DataFrame) -> T.StructType:
    """Struct type holding every column of ``df``."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
