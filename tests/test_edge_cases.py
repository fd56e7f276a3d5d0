"""Hand-made edge cases of SURVEY §7.5 and properties of the writes and windows."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marketframe import schemas as S


def d(s):
    return dt.date.fromisoformat(s)


def test_equal_priorities_break_by_source_name(spark):
    from marketframe.operators.canonical import canonical_obs
    sources = spark.createDataFrame([("B", 1), ("A", 1), ("Z", None)], S.SOURCES)
    obs = spark.createDataFrame([("I", "close", d("2020-01-01"), "B", Decimal("2")),
                                 ("I", "close", d("2020-01-01"), "A", Decimal("1")),
                                 ("I", "close", d("2020-01-02"), "Z", Decimal("3")),
                                 ("I", "close", d("2020-01-03"), "unknown", Decimal("4"))], S.OBSERVATIONS)
    got = {r.date.isoformat(): r.value for r in canonical_obs(obs, sources).collect()}
    assert got == {"2020-01-01": Decimal("1"), "2020-01-02": Decimal("3")}   # null priority still kept, last


def test_two_flows_before_one_nav_date_are_summed(spark):
    from marketframe.plans.nav import join_asof_forward
    nav = spark.createDataFrame([("P", d("2020-01-06"), 100.0), ("P", d("2020-01-13"), 120.0)],
                                "pf_id string, date date, nav double")
    flows = spark.createDataFrame([("P", d("2020-01-07"), Decimal("5")), ("P", d("2020-01-09"), Decimal("7")),
                                   ("P", d("2020-01-13"), Decimal("1")), ("P", d("2020-01-20"), Decimal("9"))],
                                  "pf_id string, date date, cashflow decimal(28,8)")
    got = {r.nav_date.isoformat(): float(r.cashflow) for r in join_asof_forward(flows, nav).collect()}
    assert got == {"2020-01-13": 13.0}     # flow after the last NAV date drops out


def test_split_compounding(spark):
    from marketframe.plans.statement import units_before_split
    rows = [("open", 10.0, None), ("split", 0.0, "2:1"), ("close", -5.0, None), ("split", 0.0, "3:1"),
            ("open", 4.0, None), ("split", 0.0, "1:2")]
    ledger = spark.createDataFrame([(dt.datetime(2020, 1, i + 1), i, "P1", t, u, n) for i, (t, u, n) in enumerate(rows)],
                                   "ts timestamp, row_no long, position_id string, type string, units double, notes string")
    got = [r.units for r in units_before_split(ledger).orderBy("row_no").collect()]
    assert [got[1], got[3], got[5]] == [10.0, 30.0, -24.5]


def test_nan_value_is_quarantined(spark):
    from marketframe.operators.quality import check_not_null
    df = spark.createDataFrame([("a", 1.0), ("b", float("nan")), ("c", None)], "k string, v double")
    assert sorted(r.k for r in check_not_null(df, ["v"]).collect()) == ["b", "c"]


def test_overlap_including_containment(spark):
    from marketframe.operators.quality import check_no_overlap
    ranges = spark.createDataFrame([("I", "A", d("2000-01-01"), d("2010-01-01")),
                                    ("I", "B", d("2003-01-01"), d("2004-01-01")),   # inside the first
                                    ("I", "C", d("2010-01-01"), d("2011-01-01")),   # touches, half-open: fine
                                    ("J", "A", d("2000-01-01"), d("2001-01-01"))], S.INSTRUMENT_UNITS)
    bad = check_no_overlap(ranges).collect()
    assert [(r.instrument_id, r.unit) for r in bad] == [("I", "B")]


def test_upsert_last_batch_row_wins_and_is_idempotent(spark):
    from marketframe.operators.writes import upsert_observations
    cur = spark.createDataFrame([("I", "close", d("2020-01-01"), "YAHOO", Decimal("1"))], S.OBSERVATIONS)
    batch = spark.createDataFrame([("I", "close", d("2020-01-01"), "YAHOO", Decimal("5"), 1),
                                   ("I", "close", d("2020-01-01"), "YAHOO", Decimal("6"), 2),
                                   ("I", "close", d("2020-01-02"), "YAHOO", Decimal("7"), 1)],
                                  "instrument_id string, field string, date date, source string, value decimal(19,5), seq int")
    once = upsert_observations(cur, batch, "seq")
    twice = upsert_observations(once, batch, "seq")
    a = sorted((r.date, r.value) for r in once.collect())
    assert a == [(d("2020-01-01"), Decimal("6")), (d("2020-01-02"), Decimal("7"))]
    assert sorted((r.date, r.value) for r in twice.collect()) == a


def test_strict_insert_rejects_duplicates(spark):
    import pytest
    from marketframe.operators.writes import DuplicateKeyError, insert_strict_identifiers
    cur = spark.createDataFrame([("I", "YAHOO", "X")], S.IDENTIFIERS)
    with pytest.raises(DuplicateKeyError):
        insert_strict_identifiers(cur, spark.createDataFrame([("I", "YAHOO", "Y")], S.IDENTIFIERS)).collect()


def test_vendor_split_unadjust_and_first_row_drop(spark):
    from marketframe.plans.vendor import vendor_to_observations
    v = spark.createDataFrame([("T", d("2020-01-01"), 10.0, 10.0, 0.0), ("T", d("2020-01-02"), 11.0, 11.0, 2.0),
                               ("T", d("2020-01-03"), 12.0, 12.1, 0.0)],
                              "ticker string, date date, close double, adj_close double, stock_splits double")
    out = {(r.field, r.date.day): r.value for r in vendor_to_observations(v, ["close", "totret"]).collect()}
    assert out[("close", 2)] == 11.0 and out[("close", 3)] == 12.0 and ("close", 1) not in out
    assert abs(out[("totret", 3)] - 10.0) < 1e-9


def test_statement_fee_and_signs(spark):
    from marketframe.plans.statement import convert_statement
    ts = dt.datetime(2024, 1, 2, 10)
    st = spark.createDataFrame([(ts, "Open Position", "ABC/USD", 100.0, 2.0, "P1", 1),
                                (ts, "Commission", "ABC/USD", -1.5, None, "P1", 2),
                                (ts, "Deposit", "Deposit", 500.0, None, None, 3)],
                               "date timestamp, type string, details string, amount double, units double, "
                               "position_id string, row_no long")
    cand = spark.createDataFrame([("ABC", 0, "ABC", False, 7)],
                                 "lookup string, pos long, symbol_full string, is_internal boolean, instrument_key long")
    ids = spark.createDataFrame([("EQU7", "ETORO", "7")], S.IDENTIFIERS)
    rows = {r.type: r for r in convert_statement(st, cand, ids).collect()}
    assert set(rows) == {"open", "deposit"}
    assert rows["open"].cashflow_usd == -101.5 and rows["open"].fee == 1.5 and rows["open"].instrument_id == "EQU7"
    assert rows["deposit"].instrument_id is None and rows["deposit"].cashflow_usd == 500.0


def test_dense_index_equals_row_number_at_volume(spark):
    """Many rows with payload, so that range bounds are sampled: the positions, not just their count."""
    from pyspark.sql import Window

    from marketframe.operators.windows import assign_batches, dense_index
    n = 240_000
    df = spark.range(n, numPartitions=6).select((F.col("id") % 3).alias("g"), F.format_string("t%07d", (F.col("id") * 7919) % n).alias("t"),
                                                F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("payload"))
    got = dense_index(df, ["g"], ["t"], out="i", n_ranges=8)
    want = F.row_number().over(Window.partitionBy("g").orderBy("t")) - 1
    assert got.withColumn("want", want).where("i != want").count() == 0 and got.count() == n and got.columns == ["g", "t", "payload", "i"]
    batches = assign_batches(df, ["g"], ["t"], 5).groupBy("g", "batch").count()
    assert batches.where("count != 5").count() == 0 and batches.count() == n // 5


def test_dense_index_of_null_groups(spark):
    from marketframe.operators.windows import dense_index
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("g", "a")], "g string, t string")
    assert sorted((str(r.g), r.t, r.i) for r in dense_index(df, "g", "t", "i").collect()) == [("None", "a", 0), ("None", "b", 1), ("g", "a", 0)]


def test_to_update_at_thousands_of_tickers(spark):
    from marketframe.plans.schedule import to_update
    n = 5000
    ids = spark.range(n).select(F.format_string("E%05d", "id").alias("instrument_id"), F.lit("YAHOO").alias("source"), F.format_string("Y%05d", "id").alias("ext_id"))
    updates = ids.select("instrument_id", F.lit("close").alias("field"), "source", F.lit("daily").alias("frequency"), F.lit(dt.date(2024, 1, 1)).alias("last_update"))
    inst = ids.select("instrument_id", F.lit("equity").alias("asset_class"))
    plan = to_update(updates, ids, inst).collect()
    assert len(plan) == n // 5 and all(len(r.tickers) == 5 for r in plan) and len({t for r in plan for t in r.tickers}) == n


def test_unknown_source_is_an_error(spark, model):
    import pytest

    from marketframe.plans.schedule import get_iid_mapping, to_update
    from marketframe.sources.scans import UnknownSourceError
    with pytest.raises(UnknownSourceError):
        to_update(model.updates, model.identifiers, model.instruments, source="YAHO", sources=model.sources)
    with pytest.raises(UnknownSourceError):
        get_iid_mapping(model.identifiers.select("ext_id"), model.identifiers, "YAHO", model.sources)


def test_normalise_dates(spark):
    from marketframe.functions.ids import normalise_dates, with_timestamps
    day = dt.datetime(2024, 3, 15)
    text = ["2024-03-15", "15/03/2024", "March 15th 2024", "2024-03-15T00:00:00Z", "2024-03-15T01:00:00.5+01:00", "20240315", "junk", None]
    df = spark.createDataFrame([(x,) for x in text], "x string")
    got = [(r.t, r.t_error) for r in with_timestamps(df, "x", "t", dayfirst=True).collect()]
    assert [t for t, _ in got] == [day, day, day, day, day + dt.timedelta(seconds=0.5), day, None, None]
    assert [e for _, e in got] == [None] * 6 + ["unreadable date: junk", None]
    numbers = spark.createDataFrame([(86400, 1710460800.0), (-1, 0.25), (0, float("nan"))], "n long, d double")
    got = numbers.select(normalise_dates(F.col("n"), numeric=True).alias("n"), normalise_dates(F.col("d"), numeric=True).alias("d")).collect()
    epoch = dt.datetime(1970, 1, 1)
    assert [r.n for r in got] == [dt.datetime(1970, 1, 2), epoch - dt.timedelta(seconds=1), epoch]
    assert [r.d for r in got] == [day, epoch + dt.timedelta(seconds=0.25), None]


def test_split_with_bad_ratios_and_no_position(spark):
    from marketframe.plans.statement import units_before_split
    rows = [("P", 1, "open", 10.0, None), ("P", 2, "split", None, "2:1"), ("P", 3, "split", None, "0:1"), ("P", 4, "split", None, "bad"), ("P", 5, "close", -5.0, None),
            ("P", 6, "split", None, "1:3"), (None, 7, "open", 3.0, None), (None, 8, "split", None, "2:1"), ("Q", 9, "open", 4.0, None)]
    df = spark.createDataFrame(rows, "position_id string, ts int, type string, units double, notes string").withColumn("row_no", F.col("ts"))
    got = {r.ts: (r.units, r.split_error) for r in units_before_split(df).collect()}
    assert got[2] == (10.0, None) and got[3] == (None, "unusable split ratio: 0:1") and got[4][0] is None
    assert abs(got[6][0] + 10.0) < 1e-9 and got[8] == (0.0, None) and got[7][0] == 3.0 and got[9][0] == 4.0


def test_missing_tickers_error_has_them_all(spark):
    import pytest

    from marketframe.plans.hist import MissingTickersError, get_hist_checked
    ts = spark.createDataFrame([("I", "T0", "close", dt.date(2024, 1, 1), 1.0)], "instrument_id string, internal_ticker string, field string, date date, value double")
    with pytest.raises(MissingTickersError) as e:
        get_hist_checked(ts, [f"T{i}" for i in range(80)], ["close"], None, None)
    assert e.value.rows.count() == 79 and "79 rows" in str(e.value)
    wide = get_hist_checked(ts, ["T0"], ["close", "totret"], None, None, wide=True)
    assert wide.columns == ["date", "T0_close", "T0_totret"] and wide.first()[1:] == (1.0, None)


def test_checkpoint_folder_must_be_named_on_a_cluster():
    import pytest

    from marketframe.session import checkpoint_dir

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        checkpoint_dir(Cluster)


def test_pivot_pages_hold_every_ticker_and_value(spark):
    from marketframe.plans.hist import pivot_history_pages
    rows = [(f"T{i:02d}", f, dt.date(2020, 1, d), float(100 * i + d)) for i in range(11) if i != 6 for f in ("close", "totret") for d in (1, 2) if (i, d) != (3, 2)]
    hist = spark.createDataFrame(rows, "ticker string, field string, date date, value double")
    tickers = spark.createDataFrame([(f"T{i:02d}",) for i in range(11)] + [("T01",)], "ticker string")
    wide = pivot_history_pages(hist, tickers, ["close", "totret"], 4).collect()
    assert sorted((str(r.date), r.page) for r in wide) == [(f"2020-01-0{d}", p) for d in (1, 2) for p in (0, 1, 2)]
    back = [(r[f"ticker_{k}"], f, r.date, r[f"{f}_{k}"]) for r in wide for k in range(4) for f in ("close", "totret") if r[f"{f}_{k}"] is not None]
    assert sorted(back) == sorted(rows)
    assert all((r.ticker_2 is None) == (r.page == 1) for r in wide)
    assert pivot_history_pages(hist, tickers.limit(0), ["close"], 4).count() == 0


def test_many_ranges_a_key_attach_as_a_range_join_does(spark):
    """Random ranges (nested, equal, open, empty, reversed) against every pair compared in plain Python."""
    import random
    from marketframe.plans.usd import attach_effective_range
    rnd, day0 = random.Random(3), dt.date(2019, 11, 1)
    day = lambda: day0 + dt.timedelta(days=rnd.randrange(500))
    ranges = [(k, s, s + dt.timedelta(days=rnd.randrange(-2, 9)), i) for k in "ABC" for i in range(80) for s in [day()]]
    ranges += [ranges[0][:3] + (900,), ("A", day0, dt.date(9999, 12, 31), 901), (None, day0, day(), 902), ("B", None, day(), 903), ("C", day(), None, 904)]
    facts = [(k, day(), f"{k}{i}") for k in "ABCD" for i in range(150)] + [(None, day0, "x"), ("A", None, "y")] * 2
    facts += facts[:3]
    got = attach_effective_range(spark.createDataFrame(facts, "instrument_id string, date date, note string"),
                                 spark.createDataFrame(ranges, "instrument_id string, start_date date, end_date date, n int"), bucket="month")
    want = []
    for k, at, note in facts:
        hits = [n for rk, s, e, n in ranges if k and at and rk == k and s and e and s <= at < e]
        if hits:
            want.append((note, hits[0] if len(hits) == 1 else None, None if len(hits) == 1 else f"{len(hits)} ranges are valid on this day"))
    key = lambda t: tuple(map(str, t))
    assert sorted(((r.note, r.n, r.range_error) for r in got.collect()), key=key) == sorted(want, key=key)
    assert {w[2] is None for w in want} == {True, False}


def test_attach_refuses_clashing_columns_and_takes_empty_tables(spark):
    import pytest
    from marketframe.plans.usd import attach_effective_range
    facts = spark.createDataFrame([("A", d("2020-01-01"))], "instrument_id string, date date")
    none = spark.createDataFrame([], "instrument_id string, start_date date, end_date date, unit string")
    assert attach_effective_range(facts, none).collect() == []
    assert attach_effective_range(facts.limit(0), none).collect() == []
    with pytest.raises(ValueError, match="date"):
        attach_effective_range(facts, none.withColumnRenamed("unit", "date"))


def test_semi_and_anti_join_read_each_member_key_once(spark):
    from marketframe.operators import relational as R
    left = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "k string")
    members = spark.createDataFrame([("A", i) for i in range(50)] + [(None, 1)], "k string, v int")
    assert sorted(r.k for r in R.join_semi(left, members, "k").collect()) == ["A", "A"]
    assert sorted(str(r.k) for r in R.join_anti(left, members, "k").collect()) == ["B", "None"]
    for join in (R.join_semi, R.join_anti):
        plan = join(left, members, ["k"])._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [k" in plan       # the join's side holds keys, not rows


def test_rows_are_not_shuffled_by_source_or_field(spark):
    from marketframe.operators.canonical import canonical_obs
    from marketframe.plans.usd import time_series_usd_dated
    obs = spark.createDataFrame([("I", "close", d("2020-01-01"), "A", Decimal("2"))], S.OBSERVATIONS)
    sources = spark.createDataFrame([("A", 1)], S.SOURCES)      # of a size the planner doesn't know
    canonical = canonical_obs(obs, sources)
    assert "hashpartitioning(source" not in canonical._jdf.queryExecution().executedPlan().toString()
    fields = spark.createDataFrame([("close", "value")], "name string, fx_conversion string")
    inst = spark.createDataFrame([("I", "ABC", "equity")], "instrument_id string, internal_ticker string, asset_class string")
    units = spark.createDataFrame([("I", "USD", d("1900-01-01"), d("9999-12-31"))], "instrument_id string, unit string, start_date date, end_date date")
    fx = spark.createDataFrame([("USD", d("2020-01-01"), Decimal("3"), 1.0)], "code string, date date, value decimal(24,9), change double")
    got = time_series_usd_dated(canonical, inst, fields, units, fx)
    assert "hashpartitioning(field" not in got._jdf.queryExecution().executedPlan().toString()
    assert [float(r.value) for r in got.collect()] == [6.0]


def test_core_queries_gather_small_tasks(spark):
    import __spark_entry__ as entry
    from marketframe.session import TASK_BYTES
    key = TASK_BYTES[0]
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        entry._prepare(spark)
        assert spark.conf.get(key) in ("16m", "16777216b")
    finally:
        spark.conf.set(key, before)


def test_observations_are_grouped_by_the_short_key(spark, tmp_path):
    from marketframe.sources.driver_tables import ModelTables
    rows = [(7, "O", "A", dt.datetime(2020, 1, 1), 5.0), (7, "O", "A", dt.datetime(2020, 1, 3, 23), 6.0), (7, "O", "A", dt.datetime(2020, 1, 6), 1.0),
            (7, "F", "R", dt.datetime(2020, 1, 1), 9.0), (None, "O", None, None, 2.0)]
    spark.createDataFrame([(*r, 0.06, 0.01) for r in rows], "l_suppkey long, l_linestatus string, l_returnflag string, l_shipdate timestamp, "
                          "l_extendedprice double, l_discount double, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = ModelTables(spark, str(tmp_path)).equity_observations
    assert "Aggregate [l_suppkey" in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.columns == [*S.OBS_KEY, "value"]
    key = "EQU" + "7".rjust(17, "0")
    want = {(key, "close", d("2019-12-30"), "LSEG", 6.0), (key, "close", d("2020-01-06"), "LSEG", 1.0), (key, "totret", d("2019-12-30"), "ETORO", 5.0), (None, "close", None, "ETORO", 2.0)}
    assert {(r.instrument_id, r.field, r.date, r.source, float(r.value)) for r in got.collect()} == want


def test_closes_meet_holdings_without_sorting_both(spark):
    from marketframe.plans.holdings import _with_closes
    held = spark.createDataFrame([("P", "I", d("2020-01-01") + dt.timedelta(days=i), 1) for i in range(3)], "pf_id string, instrument_id string, date date, units int")
    prices = spark.createDataFrame([("I", "close", d("2020-01-02"), 4)], "instrument_id string, field string, date date, value int")
    got = _with_closes(held, prices)
    assert "ShuffledHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert [r.close_usd for r in got.orderBy("date").collect()] == [None, 4, 4]


def test_closes_are_filled_by_balance_and_days_are_not_shuffled(spark):
    from marketframe.plans.holdings import KEY, _on_days, _with_closes, portfolio_holdings
    day = lambda i: d("2020-01-01") + dt.timedelta(days=i)      # noqa: E731
    ledger = [("P", "I", day(1), 5), ("P", "I", day(3), -5), ("P", "I", day(6), 2), ("P", None, day(2), 1), ("Q", "I", day(4), 1), ("Q", "J", day(5), 3), ("Q", "I", day(7), 1)]
    combined = spark.createDataFrame([(*r[:3], Decimal(r[3])) for r in ledger], "pf_id string, instrument_id string, date date, units decimal(38,8)")
    closes = [("I", 2, 4), ("I", 4, 9), ("I", 7, None), ("I", 8, 7), ("I", 8, 6), ("J", 1, 1), (None, 3, 3)]
    ts = spark.createDataFrame([(i, "close", day(n), None if v is None else Decimal(v)) for i, n, v in closes] + [("I", "totret", day(1), Decimal(50))],
                               "instrument_id string, field string, date date, value decimal(19,5)")
    days = spark.createDataFrame([(day(i),) for i in range(1, 10)], "date date")
    got = portfolio_holdings(None, ts, None, combined=combined, days=days)
    above = got._jdf.queryExecution().executedPlan().toString().split("Generate explode(")[0]
    assert "Exchange hashpartitioning" not in above and "Window" not in above      # no row by day is dealt or sorted
    rows = sorted((r.pf_id, r.instrument_id or "", r.date.day - 1, int(r.units), r.close_usd and int(r.close_usd)) for r in got.collect())
    last = [r for r in rows if r[:3] == ("P", "I", 9) or r[:3] == ("Q", "I", 9)]
    want = [("P", "", i, 1, None) for i in range(2, 10)] + [("P", "I", 1, 5, None), ("P", "I", 2, 5, 4), ("P", "I", 6, 2, 4), ("P", "I", 7, 2, 4), ("P", "I", 8, 2, 6), ("P", "I", 8, 2, 7)]
    want += [("Q", "I", i, 1, 9) for i in (4, 5, 6)] + [("Q", "I", 7, 2, 9), ("Q", "I", 8, 2, 6), ("Q", "I", 8, 2, 7)] + [("Q", "J", i, 3, None) for i in range(5, 10)]
    assert [r for r in rows if r not in last] == sorted(want, key=str)
    assert [(*r[:4], r[4] in (6, 7)) for r in last] == [("P", "I", 9, 2, True), ("Q", "I", 9, 2, True)]      # of two closes of a day, either is carried
    once = ts.where("value is null or value <> 6")
    spans = combined.selectExpr(*KEY, "date as from_date", "sum(units) over (partition by pf_id, instrument_id order by date) as units",
                                "lead(date) over (partition by pf_id, instrument_id order by date) as to_date").where("units > 0")
    plain = _with_closes(_on_days(spans, days), once)
    new = portfolio_holdings(None, once, None, combined=combined, days=days)
    assert sorted(map(str, plain.select(*new.columns).collect())) == sorted(map(str, new.collect()))


def test_refresh_of_portfolios_does_not_shuffle_the_observations(spark):
    from marketframe.plans.nav import refresh_portfolios
    obs = spark.createDataFrame([("P", "close", d("2020-01-01"), "system", Decimal(1)), ("I", "close", d("2020-01-01"), "LSEG", Decimal(2)), ("I", "close", d("2020-01-01"), "LSEG", Decimal(2))], S.OBSERVATIONS)
    held = spark.createDataFrame([("P", "I", d("2020-01-01"), Decimal(3), Decimal(2))], "pf_id string, instrument_id string, date date, units decimal(38,8), close_usd decimal(19,5)")
    got = refresh_portfolios(obs, held, spark.createDataFrame([], S.PORTFOLIO_ACTIVITY))
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.instrument_id, r.field, r.source, int(r.value)) for r in got.collect()) == [("I", "close", "LSEG", 2), ("I", "close", "LSEG", 2), ("P", "close", "system", 6)]
