"""Point-in-time (leak-free) features: F1-F10.

Every feature of a row uses only that row and rows before it in the stable
order (t, id).  Rows whose card is NULL get NULL features (pandas drops NULL
group keys).

Scale notes
-----------
* Velocity (F1) deals rows by (card, t) into ranges, so a card with a third of
  all rows, even within one window length, spreads over many tasks.  A window
  is put together from two running sums over blocks of its own length, by
  addition only.  Keys and amounts are moved; payload joins the result once.
* Prior stats and prior distinct counts (F3-F6) are one segmented prefix
  sum (``ordering.prefix_sum``) over the rows plus one "first occurrence"
  marker per (card, value); the markers come from a partially aggregated
  ``groupBy`` so a hot (card, value) pair never sits in one task.
* Fitted encoders (F7, F8) are small model tables; the hour table has at
  most 24 rows and is broadcast; the frequency table is written once
  (``modeltables.keep``) and joined, and the planner sees its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import number
from .modeltables import keep
from .ordering import attach, deal, edge_offsets, prefix_sum, range_count

SECONDS_PER_DAY = 86400
# Default velocity windows (label -> seconds), as in the reference: 1 hour, 1 day.
DEFAULT_WINDOWS = {"1h": 3600, "1d": 86400}


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("no rows to make features from")


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "df") -> None:
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")


# ---------------------------------------------------------------------------
# F1/F2 velocity
# ---------------------------------------------------------------------------

def add_velocity_features(
    df: DataFrame,
    card_col: str = "card",
    time_col: str = "t",
    amount_col: str = "amount",
    id_col: str = "id",
    windows_seconds: Mapping[str, int | None] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Count and sum of the card's amounts in (t - d, t] per window.  An empty
    frame is an error.

    Of rows in the same second only those at or before the current row in
    (t, id) order count.  ``count`` ignores NULL amounts; the sum over a
    window without non-NULL amounts is NULL.  A window of ``None`` means the
    whole history up to the row.  Rows that agree in card, t and id get the
    counts of the last of them.
    """
    windows = dict(DEFAULT_WINDOWS if windows_seconds is None else windows_seconds)
    require_columns(df, [card_col, time_col, amount_col, id_col])
    require_rows(df)
    bounded = {k: int(v) for k, v in windows.items() if v is not None}
    for k, v in bounded.items():
        if v < 1:
            raise ValueError(f"window {k!r} must be at least 1 second")

    keys = [card_col, time_col, id_col]
    narrow = df.where(F.col(card_col).isNotNull()).select(*keys, number(amount_col).alias("__a"))
    found, made = None, []
    if bounded:
        found = _bounded_velocity(narrow, *keys, bounded, ranges)
        made += [c for label in bounded for c in (f"{card_col}_txn_count_{label}", f"{card_col}_amt_sum_{label}")]
    for label in (k for k, v in windows.items() if v is None):
        cname, sname = f"{card_col}_txn_count_{label}", f"{card_col}_amt_sum_{label}"
        cum = prefix_sum(narrow, [time_col, id_col], {cname: F.col("__a").isNotNull().cast("long"), sname: F.col("__a")}, partition_by=[card_col], buckets=ranges)
        cum = cum.withColumn(sname, F.when(F.col(cname) > 0, F.col(sname)))
        found = cum if found is None else attach(found, cum, keys, [cname, sname])
        made += [cname, sname]
    if found is None:
        return df
    # rows without a card find nothing
    return attach(df, found, keys, made)


def _bounded_velocity(narrow: DataFrame, card: str, t: str, id_col: str, windows: Mapping[str, int], ranges: int | None) -> DataFrame:
    """Rows (card, t, id) with count and sum of ``__a`` per window.

    Time is cut into blocks as long as the window.  A window then is the
    running sum within the row's own block plus the sum of what the block before
    holds after t - d.  Both only add what lies inside, so nothing cancels and an
    infinity counts where it stands.  "After t - d" is asked by a row of its own,
    dealt with the others by (card, t), so the answer comes from the range where
    the time lies, and running sums go on from range to range."""
    rows = narrow.select(F.col(card).alias("__c"), F.col(t).alias("__t"), F.lit(-1).alias("__q"), F.col(id_col).alias("__i"), F.col("__a").alias("__a"), F.lit(None).cast(narrow.schema[t].dataType).alias("__home"))
    # a second asks once, however many rows it has
    seconds = narrow.select(F.col(card).alias("__c"), F.col(t).alias("__home")).distinct()
    asks = F.explode(F.array(*[F.struct(F.lit(k).alias("q"), (F.col("__home") - F.lit(d)).alias("at")) for k, d in enumerate(windows.values())]))
    none = F.lit(None)
    asked = seconds.select("__c", "__home", asks.alias("x")).select(
        "__c", F.col("x.at").cast(narrow.schema[t].dataType).alias("__t"), F.col("x.q").alias("__q"), none.cast(narrow.schema[id_col].dataType).alias("__i"), none.cast("double").alias("__a"), "__home"
    )
    # rows stand before questions of the same second, which ask for what is later
    late = F.col("__q") >= 0
    dealt = deal(rows.withColumn("__a", F.col("__a").cast("double")).unionByName(asked), range_count(narrow, ranges), F.col("__c"), F.col("__t"), late, F.col("__i"))
    n, a = F.col("__a").isNotNull().cast("long"), F.col("__a")
    blocks = {f"__b{k}": F.floor(F.col("__t") / F.lit(d)).cast("long") for k, d in enumerate(windows.values())}
    chains = _nested(list(windows.values()), isinstance(narrow.schema[t].dataType, T.IntegralType))

    def running(kept: DataFrame, way: str, later: bool) -> DataFrame:
        """Each row's sums over its own blocks, from their beginning or (``later``) end,
        with what other ranges hold of them.  One sort serves all windows of a chain."""
        out = kept.withColumns(blocks).repartition(range_count(narrow, ranges), "__rng", "__c")
        for chain in chains:
            steps = [-F.col(f"__b{k}") if later else F.col(f"__b{k}") for k in chain]
            out = out.withColumns({f"__w{j}": c for j, c in enumerate(steps)})
            for j, k in enumerate(chain):
                inside = [f"__w{i}" for i in range(len(chain))]
                end = [F.desc("__t"), late.desc(), F.desc("__i")] if later else [F.asc("__t"), F.asc("__i")]
                over = Window.partitionBy("__rng", "__c", *inside[: j + 1]).orderBy(*inside[j + 1 :], *end).rowsBetween(Window.unboundedPreceding, Window.currentRow)
                out = out.withColumns({f"__{way}n{k}": F.sum(n).over(over), f"__{way}s{k}": F.sum(a).over(over)})
            out = out.drop(*[f"__w{j}" for j in range(len(chain))])
        if later:
            out = out.where(late)  # the others were there to be added
        for k, block in enumerate(blocks.values()):
            offsets = edge_offsets(dealt, F.struct("__c", block.alias("b")), {f"__o{way}n{k}": n, f"__o{way}s{k}": a}, later, fine=True)
            offsets = offsets.select(F.col("__rng").alias("__r"), F.col("__seg.__c").alias("__oc"), F.col("__seg.b").alias("__ob"), f"__o{way}n{k}", f"__o{way}s{k}")
            same = (F.col("__rng") == F.col("__r")) & (F.col("__c") == F.col("__oc")) & F.col(f"__b{k}").eqNullSafe(F.col("__ob"))
            out = out.join(F.broadcast(offsets), same, "left").drop("__r", "__oc", "__ob")  # two rows per range at most
        return out

    def total(way: str, what: str, k: int) -> Column:
        return F.coalesce(F.col(f"__{way}{what}{k}"), F.lit(0)) + F.coalesce(F.col(f"__o{way}{what}{k}"), F.lit(0))

    cols = {}
    for k, label in enumerate(windows):
        cols[f"{card}_txn_count_{label}"], cols[f"{card}_amt_sum_{label}"] = ("n", k), ("s", k)
    both_sums = [(what, k) for k in range(len(windows)) for what in "ns"]
    # Both sides of the join below are written once: a row with its own sums, a
    # question with what it asked for.  Rows need no questions beside them.
    own = keep(running(dealt.where(~late), "p", False).select("__c", "__t", "__i", *[total("p", *x).alias("__x{}{}".format(*x)) for x in both_sums]))
    asks = keep(running(dealt, "s", True).select(F.col("__c").alias("__ac"), F.col("__home").alias("__at"), *[F.when(F.col("__q") == x[1], total("s", *x)).alias("__a{}{}".format(*x)) for x in both_sums]))
    # an answer is one value per (card, second)
    answered = asks.groupBy("__ac", "__at").agg(*[F.max("__a{}{}".format(*x)).alias("__a{}{}".format(*x)) for x in both_sums])
    both = own.join(answered, (F.col("__c") == F.col("__ac")) & (F.col("__t") == F.col("__at")), "left")

    def window(what: str, k: int) -> Column:
        return F.col(f"__x{what}{k}") + F.coalesce(F.col(f"__a{what}{k}"), F.lit(0))

    made = [
        (window("n", k).cast("long") if what == "n" else F.when(window("n", k) > 0, window("s", k))).alias(name) for name, (what, k) in cols.items()
    ]
    return both.select(F.col("__c").alias(card), F.col("__t").alias(t), F.col("__i").alias(id_col), *made)


def _nested(lengths: Sequence[int], whole: bool) -> list[list[int]]:
    """The windows by number, in chains: every length divides the one before it, so
    every block lies in one block of that.  Only of whole times is that exact."""
    chains: list[list[int]] = []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        chain = next((c for c in chains if whole and lengths[c[-1]] % lengths[k] == 0), None)
        if chain is None:
            chains.append([k])
        else:
            chain.append(k)
    return chains


# ---------------------------------------------------------------------------
# F3-F6 prior stats and prior distinct count
# ---------------------------------------------------------------------------

def add_card_usage_features(
    df: DataFrame,
    card_col: str = "card",
    time_col: str = "t",
    amount_col: str = "amount",
    id_col: str = "id",
    diversity_col: str | None = "diversity",
    buckets: int | None = None,
    n_hint: int | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Prior count, running average of earlier amounts, ratio to it, and
    the number of distinct non-NULL ``diversity_col`` values seen before.
    ``n_hint`` (an upper bound of rows + markers) spares the row count that
    sizes the buckets when the input is expensive to recompute.  ``source`` has the
    rows of ``df`` without what earlier steps added: keys and amounts are read from
    there, so those steps run once only, for the join at the end."""
    require_columns(df, [card_col, time_col, amount_col, id_col])
    source = df if source is None else source
    if n_hint is None:
        require_rows(source)
    has_div = diversity_col is not None and diversity_col in df.columns
    keys = [card_col, time_col, id_col]
    known = source.where(F.col(card_col).isNotNull())
    a = number(amount_col).cast("double")
    stream = known.select(*keys, a.alias("__a"), F.lit(0).alias("__kind"))
    if has_div:
        # One marker per (card, value) at its first occurrence (t, id).
        first = (
            known.where(F.col(diversity_col).isNotNull())
            .groupBy(card_col, diversity_col)
            .agg(F.min(F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("i"))).alias("__f"))
        )
        markers = first.select(
            F.col(card_col), F.col("__f.t").alias(time_col), F.col("__f.i").alias(id_col), F.lit(None).cast("double").alias("__a"), F.lit(1).alias("__kind")
        )
        stream = stream.unionByName(markers)
    is_row = F.col("__kind") == 0
    # Markers sort after their own row (kind 1 > 0).  Every sum is of strictly
    # earlier rows: nothing is taken away again, so a large or infinite amount
    # does not reach the average of its own row.
    cum = prefix_sum(
        stream,
        [time_col, id_col, "__kind"],
        {"__n": is_row.cast("long"), "__s": F.when(is_row, F.col("__a")), "__d": (~is_row).cast("long")},
        partition_by=[card_col],
        inclusive={"__n": False, "__s": False, "__d": False},
        buckets=buckets,
        n=n_hint,
    ).where(is_row)
    count, avg, ratio = f"{card_col}_prior_txn_count", f"{card_col}_running_avg_amt", f"{card_col}_amt_ratio_to_own_avg"
    cum = cum.withColumn(count, F.col("__n").cast("long"))
    cum = cum.withColumn(avg, F.when(F.col("__a").isNotNull(), F.try_divide(F.col("__s"), F.when(F.col(count) != 0, F.col(count).cast("double")))))
    cum = cum.withColumn(ratio, F.try_divide(F.col("__a"), F.when(F.col(avg) != 0, F.col(avg))))
    made = [count, avg, ratio]
    if has_div:
        made.append(f"{card_col}_prior_distinct_{diversity_col}_count")
        cum = cum.withColumn(made[-1], F.col("__d").cast("long"))
    return attach(df, cum.select(*keys, *made), keys, made)


# ---------------------------------------------------------------------------
# F7 hour-of-day aggregates, F8 frequency encoding (fit on train, apply)
# ---------------------------------------------------------------------------

def hour_of_day(t: Column | str) -> Column:
    t = F.col(t) if isinstance(t, str) else t
    return F.floor(F.pmod(t, F.lit(SECONDS_PER_DAY)) / F.lit(3600)).cast("long")


def fit_hour_of_day(fit_df: DataFrame, time_col: str = "t", amount_col: str = "amount") -> DataFrame:
    """Model table: hour -> mean amount, count (at most 24 rows)."""
    require_columns(fit_df, [time_col, amount_col], "fit_df")
    return fit_df.groupBy(hour_of_day(time_col).alias("__hour")).agg(
        F.avg(number(amount_col)).alias("hour_of_day_avg_amt"), F.count(number(amount_col)).alias("hour_of_day_txn_count")
    )


def add_hour_of_day_aggregates(
    df: DataFrame, time_col: str = "t", amount_col: str = "amount", fit_df: DataFrame | None = None
) -> DataFrame:
    require_columns(df, [time_col, amount_col])
    stats = fit_hour_of_day(fit_df if fit_df is not None else df, time_col, amount_col)
    # 24 rows at most: broadcast is size-bounded by construction.
    return (
        df.withColumn("__hour", hour_of_day(time_col))
        .join(F.broadcast(stats), "__hour", "left")
        .drop("__hour")
    )


def fit_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Model table (column, value, freq): share of rows per value, NULL
    counted as its own value.  One job for all columns (unpivot)."""
    require_columns(df, columns)
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("__kv")
    ).select("__kv.column", "__kv.value")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("__n"))
    # Totals per column: one row per column (bounded), broadcast; a window
    # over "column" would put a high-cardinality column in one task.
    totals = counts.groupBy("column").agg(F.sum("__n").alias("__tot"))
    return counts.join(F.broadcast(totals), "column").select("column", "value", (F.col("__n") / F.col("__tot")).alias("freq"))


def transform_frequencies(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<col>_freq`` per column; NULL looks up the NULL share; values
    never seen in the fit side map to 0.0.  The fitted table is written once;
    the planner sees its size."""
    table = keep(table)
    out = df
    for c in columns:
        require_columns(out, [c])
        t = table.where(F.col("column") == c).select(F.col("value").alias("__v"), F.col("freq").alias(f"{c}_freq"))
        out = out.join(t, out[c].cast("string").eqNullSafe(t["__v"]), "left").drop("__v")
        out = out.withColumn(f"{c}_freq", F.coalesce(F.col(f"{c}_freq"), F.lit(0.0)))
    return out


def frequency_encode(df: DataFrame, columns: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    return transform_frequencies(df, fit_frequencies(fit_df if fit_df is not None else df, columns), columns)


# ---------------------------------------------------------------------------
# F9 full chain, F10 leak guard
# ---------------------------------------------------------------------------

def engineer_features(
    df: DataFrame,
    card_col: str = "card",
    time_col: str = "t",
    amount_col: str = "amount",
    id_col: str = "id",
    diversity_col: str | None = "diversity",
    category_cols: Sequence[str] = ("category",),
    windows_seconds: Mapping[str, int | None] | None = None,
) -> DataFrame:
    require_rows(df)
    n = df.count()  # a plain scan; bounds the rows + markers of the next step
    out = add_velocity_features(df, card_col, time_col, amount_col, id_col, windows_seconds)
    out = add_card_usage_features(out, card_col, time_col, amount_col, id_col, diversity_col, n_hint=2 * n, source=df)
    # The feature steps keep every row, so the encoders are fitted on the
    # input itself: their fit jobs never re-run the windows above.
    out = add_hour_of_day_aggregates(out, time_col, amount_col, fit_df=df)
    cats = [c for c in category_cols if c in out.columns]
    if cats:
        out = frequency_encode(out, cats, fit_df=df)
    return out


def leakage_guard(df: DataFrame, cutoff_t: int, build, time_col: str = "t") -> DataFrame:
    """Property: features of rows at or before ``cutoff_t`` do not change
    when later rows are added.  ``build`` maps a frame to its causal
    features.  Returns one row (n_checked, n_mismatch)."""
    full = build(df).where(F.col(time_col) <= cutoff_t)
    past = build(df.where(F.col(time_col) <= cutoff_t))
    cols = sorted(full.columns)
    # One grouping of both sides: a row that one side has more often than the
    # other is a mismatch as many times as the counts differ (exceptAll both ways).
    both = full.select(*cols, F.lit(1).alias("__full"), F.lit(0).alias("__past")).unionByName(past.select(*cols, F.lit(0).alias("__full"), F.lit(1).alias("__past")))
    counts = both.groupBy(*cols).agg(F.sum("__full").alias("f"), F.sum("__past").alias("p"))
    return counts.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n_checked"), F.coalesce(F.sum(F.abs(F.col("f") - F.col("p"))), F.lit(0)).alias("n_mismatch"))
