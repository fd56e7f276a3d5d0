"""Generic relational operators: projections and filters (P), joins (J), simple
aggregates (A6, A8, A9, A13, A14), ordering (O), set operations (U) and
reshaping (R).  Each is a thin, declarative DataFrame composition so Catalyst
can push filters and prune columns through it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



# ------------------------------------------------------------------ P: projections, filters
def project_literals(df: DataFrame, literals: dict, keep: list | None = None) -> DataFrame:
    """Keep columns (renamed by ``keep`` as {new: old} or a list) and add constants."""
    if isinstance(keep, dict):
        cols = [F.col(old).alias(new) for new, old in keep.items()]
    else:
        cols = [F.col(c) for c in (keep if keep is not None else df.columns)]
    return df.select(*cols, *[F.lit(v).alias(k) for k, v in literals.items()])


def project_reorder(df: DataFrame, renames: dict, order: list | None = None) -> DataFrame:
    """Rename, then select in ``order``."""
    out = df.withColumnsRenamed(renames)
    return out.select(*(order or out.columns))


def filter_not_null(df: DataFrame, cols: list, how: str = "any") -> DataFrame:
    """Drop rows with a null (``any``) or only nulls (``all``) in ``cols``; NaN counts as null."""
    def missing(c):
        dt = dict(df.dtypes)[c]
        return F.col(c).isNull() | F.isnan(c) if dt in ("double", "float") else F.col(c).isNull()
    conds = [missing(c) for c in cols]
    if how == "all":
        return df.where(~reduce(lambda a, b: a & b, conds))
    return df.where(~reduce(lambda a, b: a | b, conds))


def filter_in_list(df: DataFrame, col: str, values) -> DataFrame:
    """``col = ANY(values)``: a predicate for a list, a semi join for a DataFrame."""
    if values is None:
        return df
    if isinstance(values, DataFrame):
        members = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(members, col, "left_semi")
    return df.where(F.col(col).isin(list(values)))


def filter_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """P5: inclusive range; a None bound is open."""
    c = F.col(col)
    if lo is not None:
        df = df.where(c >= F.lit(lo))
    if hi is not None:
        df = df.where(c <= F.lit(hi))
    return df


def filter_cutoff(df: DataFrame, col: str, cutoff) -> DataFrame:
    """``col <= cutoff``."""
    return df.where(F.col(col) <= F.lit(cutoff))


def filter_epsilon(df: DataFrame, col: str, eps) -> DataFrame:
    """Keep rows with ``col > eps``."""
    from decimal import Decimal
    return df.where(F.col(col) > F.lit(Decimal(str(eps))))


def case_expr(branches: list, default) -> Column:
    """``CASE WHEN c1 THEN v1 ... ELSE default``; ``branches`` is [(cond, value)]."""
    expr = None
    for cond, val in branches:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def coalesce_default(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace nulls per column with a default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def replace_blank_null(df: DataFrame, cols: list) -> DataFrame:
    """P10: empty or blank strings become null."""
    return df.withColumns({c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in cols})


def in_subquery(df: DataFrame, col: str, members: DataFrame, member_col: str | None = None) -> DataFrame:
    """``col IN (SELECT ...)``; nulls never match (semi join)."""
    m = members.select(F.col(member_col or members.columns[0]).alias("_m")).where(F.col("_m").isNotNull())
    return df.join(m.distinct(), F.col(col) == F.col("_m"), "left_semi")


def scalar_bounds(df: DataFrame, bounds: dict) -> DataFrame:
    """Attach uncorrelated scalar aggregates as columns via scalar subqueries.

    ``bounds`` maps a new column to (DataFrame, aggregate Column); each becomes
    one scalar subquery (``DataFrame.scalar``), evaluated once, not a join.
    """
    return df.withColumns({name: src.select(agg).scalar() for name, (src, agg) in bounds.items()})


# ------------------------------------------------------------------ J: joins
def join_inner_equi(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Many-to-one inner join to a dimension (Spark broadcasts it if its size allows)."""
    return fact.join(dim, on, "inner")


def join_using(left: DataFrame, *others: DataFrame, on: str = "instrument_id") -> DataFrame:
    """Chain of joins ``USING (on)``."""
    return reduce(lambda a, b: a.join(b, on), others, left)


def join_many_to_many_units(canonical: DataFrame, units: DataFrame) -> DataFrame:
    """Observations × every unit code of their instrument (row growth is intended)."""
    return canonical.join(units, "instrument_id")


def join_left_fill(spine: DataFrame, facts: DataFrame, on) -> DataFrame:
    """Dense spine left-joined to sparse facts."""
    return spine.join(facts, on, "left")


def join_left_mapping(requested: DataFrame, identifiers: DataFrame, source: str,
                      col: str = "ext_id") -> DataFrame:
    """External id to internal id for one source; unmatched ids keep a null.

    The source filter is applied to the identifier side before the join (the
    ON-clause form), so an unmatched id is never dropped by it.  External ids
    are not unique per source, so a lookup may fan out.
    """
    ids = identifiers.where(F.col("source") == source).select(F.col("ext_id").alias(col), "instrument_id")
    return requested.select(F.col(requested.columns[0]).cast("string").alias(col)).join(
        ids, col, "left")


def join_full_outer(spine: DataFrame, facts: DataFrame, keys: list, fill: dict | None = None) -> DataFrame:
    """Full outer join with coalesced keys; facts off the spine survive."""
    j = spine.join(facts, keys, "full_outer")   # USING-style: keys are coalesced by Spark
    return coalesce_default(j, fill or {})


def join_semi(df: DataFrame, members: DataFrame, on) -> DataFrame:
    """Rows with a match (of ``members`` the keys alone are read, each once)."""
    return df.join(distinct_rows(members, _columns(on)), on, "left_semi")


def join_anti(df: DataFrame, members: DataFrame, on) -> DataFrame:
    """Rows without a match (of ``members`` the keys alone are read, each once)."""
    return df.join(distinct_rows(members, _columns(on)), on, "left_anti")


def _columns(on) -> list:
    return [on] if isinstance(on, str) else list(on)


def join_correlated_scalar(instruments: DataFrame, units: DataFrame, n: int = 3) -> DataFrame:
    """Unit scale looked up by the first ``n`` ticker letters (null if none)."""
    u = units.select(F.col("code").alias("_code"), F.col("scale").alias("unit_scale"))
    return (instruments.join(u, F.substring("internal_ticker", 1, n) == F.col("_code"), "left")
            .drop("_code"))


def join_dict_lookup(df: DataFrame, col: str, mapping: dict, out: str) -> Column | DataFrame:
    """Small fixed dictionary lookup; unknown keys give null (``create_map``, no join)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out, m[F.col(col)])


# ------------------------------------------------------------------ A: simple aggregates
def agg_min_max(df: DataFrame, key, date_col: str = "date") -> DataFrame:
    """First and last date per key (or overall when ``key`` is None)."""
    aggs = [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    return df.groupBy(key).agg(*aggs) if key else df.agg(*aggs)


def agg_row_counts(tables: dict) -> DataFrame:
    """One row per table with its row count, stacked."""
    parts = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def agg_duplicates(df: DataFrame, cols: list) -> DataFrame:
    """Values (tuples of ``cols``) occurring more than once, with their count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def agg_row_mean(df: DataFrame, cols: list, out: str = "mean") -> DataFrame:
    """Mean across columns of a row, skipping nulls (null when all are null)."""
    present = [F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c)), F.col(c).cast("double")) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in present])
    n = reduce(lambda a, b: a + b, [p.isNotNull().cast("int") for p in present])
    return df.withColumn(out, F.when(n > 0, total / n))


def distinct_rows(df: DataFrame, cols: list | None = None) -> DataFrame:
    """``SELECT DISTINCT cols``."""
    return (df.select(*cols) if cols else df).distinct()


def agg_null_counts(df: DataFrame, cols: list) -> DataFrame:
    """Number of missing values per column (NaN counts as missing)."""
    def missing(c):
        dt = dict(df.dtypes)[c]
        m = F.col(c).isNull() | F.isnan(c) if dt in ("double", "float") else F.col(c).isNull()
        return F.count_if(m).alias(c)
    wide = df.agg(*[missing(c) for c in cols])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                    F.col(c).cast("long").alias("n_null")) for c in cols]))
                       .alias("r")).select("r.*")


# ------------------------------------------------------------------ O: order, limit
def order_by_date(df: DataFrame, *ties: str) -> DataFrame:
    """O1: sort by date ascending (then the given tie-breakers); apply last."""
    return df.orderBy("date", *ties)


def first_by_order(df: DataFrame, col: str = "date") -> DataFrame:
    """O2: earliest value as an aggregate (no sort)."""
    return df.agg(F.min(col).alias(f"first_{col}"))


def preview_limit(df: DataFrame, order: list, n: int) -> DataFrame:
    """O3: first ``n`` rows in an explicit order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


# ------------------------------------------------------------------ U: set operations
def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def set_difference_missing(requested: DataFrame, received: DataFrame, col: str) -> DataFrame:
    """Requested keys with no received row."""
    return requested.select(col).distinct().join(received.select(col), col, "left_anti")


def set_union_ids(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Distinct union of two id sets."""
    return a.select(col).union(b.select(col)).distinct()


# ------------------------------------------------------------------ R: reshape
def unpivot_columns(df: DataFrame, ids: list, values: list, var: str, val: str,
                    dropna: bool = False) -> DataFrame:
    """Wide to long, keeping ``ids``."""
    out = df.unpivot(ids, values, var, val)
    return out.where(F.col(val).isNotNull()) if dropna else out


def unpivot_stack(df: DataFrame, ids: list, pairs: list, var: str, val: str,
                  dropna: bool = False, cast: str = "string") -> DataFrame:
    """``stack`` of (label, column) pairs, values cast to one type."""
    args = ", ".join(f"'{label}', CAST(`{c}` AS {cast})" for label, c in pairs)
    out = df.selectExpr(*[f"`{i}`" for i in ids], f"stack({len(pairs)}, {args}) AS (`{var}`, `{val}`)")
    return out.where(F.col(val).isNotNull()) if dropna else out


def unnest_array(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """One row per array element."""
    return df.withColumn(out or col, F.explode(col))


def calendar_spine(df: DataFrame, date_col: str = "date", out: str = "date") -> DataFrame:
    """Every day from the first to the last date of ``df`` (one generated row per day)."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias(out))
