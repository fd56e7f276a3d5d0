"""Golden rows from the reference's worked examples (FIXTURES.md G1-G4)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marketframe import schemas as S


def d(s):
    return dt.date.fromisoformat(s)


def test_g1_fx_value_and_change(spark):
    from marketframe.plans.fx import units_ts
    obs = [("1979-12-31", "1.106580956100"), ("1980-01-02", "1.108512276900"), ("1980-01-03", "1.110000555000"),
           ("1980-01-04", "1.110112167000"), ("1980-01-07", "1.113816908000")]
    # Observations stored in pipettes (value / scale) for one currency instrument.
    canonical = spark.createDataFrame(
        [("CURAUD", "close", d(x), (Decimal(v) * 100000).quantize(Decimal("0.00001"))) for x, v in obs],
        "instrument_id string, field string, date date, value decimal(19,5)")
    units = spark.createDataFrame([("AUD", Decimal("0.00001"), "CURAUD")], S.UNITS)
    got = {r.date.isoformat(): (float(r.value), r.change) for r in units_ts(canonical, units).collect()}
    assert len(got) == 8
    expected = {"1979-12-31": (1.1065809561, 1.0), "1980-01-01": (1.1065809561, 1.0),
                "1980-01-02": (1.1085122769, 1.0017453045702202), "1980-01-03": (1.110000555, 1.0013425905432117),
                "1980-01-04": (1.110112167, 1.0001005513010757), "1980-01-05": (1.110112167, 1.0),
                "1980-01-06": (1.110112167, 1.0), "1980-01-07": (1.113816908, 1.0033372672691371)}
    for k, (v, c) in expected.items():
        assert abs(got[k][0] - v) < 1e-12, k
        assert abs(got[k][1] - c) < 1e-15, k


def test_g2_two_units_on_one_instrument(spark):
    from marketframe.plans.fx import fx_base
    canonical = spark.createDataFrame([("CURGBP", "close", d("1979-12-31"), Decimal("222519.45705"))],
                                      "instrument_id string, field string, date date, value decimal(19,5)")
    units = spark.createDataFrame([("GBP", Decimal("0.00001"), "CURGBP"), ("GBp", Decimal("0.0000001"), "CURGBP")],
                                  S.UNITS)
    got = {r.code: r.value for r in fx_base(canonical, units).collect()}
    assert got["GBP"] == Decimal("2.225194570500")
    assert got["GBp"] == Decimal("0.022251945705")   # case-sensitive code, exactly 1/100


def test_g3_pull_plan(spark):
    from marketframe.plans.schedule import to_update
    ids = {"E1": "AAPL", "E2": "MSFT", "E3": "GOOGL", "E4": "VOO", "E5": "SPY", "C1": "=EUR"}
    instruments = spark.createDataFrame([(k, k, "currency" if k.startswith("C") else "equity", v)
                                         for k, v in ids.items()], S.INSTRUMENTS)
    identifiers = spark.createDataFrame([(k, "YAHOO", v) for k, v in ids.items()], S.IDENTIFIERS)
    rows = []
    for k in ids:
        fields = ["close", "totret"] if k in ("E1", "E2", "E3") else ["close"]
        rows += [(k, f, "YAHOO", "daily", d("2026-01-01")) for f in fields]
    updates = spark.createDataFrame(rows, S.UPDATES)
    plan = to_update(updates, identifiers, instruments, batch_size=100)
    got = {(r.asset_class, tuple(r.field_set)): r.tickers for r in plan.collect()}
    assert got == {("equity", ("close", "totret")): ["AAPL", "GOOGL", "MSFT"],
                   ("equity", ("close",)): ["SPY", "VOO"], ("currency", ("close",)): ["=EUR"]}


def test_g3_batches_of_five(spark):
    from marketframe.plans.schedule import to_update
    n = 12
    instruments = spark.createDataFrame([(f"E{i}", f"E{i}", "equity", f"T{i:02d}") for i in range(n)], S.INSTRUMENTS)
    identifiers = spark.createDataFrame([(f"E{i}", "YAHOO", f"T{i:02d}") for i in range(n)], S.IDENTIFIERS)
    updates = spark.createDataFrame([(f"E{i}", "close", "YAHOO", "daily", d("2026-01-01")) for i in range(n)], S.UPDATES)
    plan = sorted(to_update(updates, identifiers, instruments, batch_size=5).collect(), key=lambda r: r.batch)
    assert [len(r.tickers) for r in plan] == [5, 5, 2]
    assert plan[0].tickers == [f"T{i:02d}" for i in range(5)]


def test_g4_instrument_ids(spark):
    from marketframe.functions.ids import create_instrument_id, valid_isin
    rows = [("equity", "AAPL", "US0378331005"), ("equity", "MSFT", "US5949181045"), ("currency", "USD", "USD"),
            ("currency", "GBP", "USD"), ("equity", "AAPL", "US0378331006"), ("equity", "TOOLONG", "US0378331005")]
    df = spark.createDataFrame(rows, "ac string, code string, h string")
    got = [r.iid for r in df.select(create_instrument_id(F.col("ac"), F.col("code"), F.col("h")).alias("iid")).collect()]
    assert got == ["EQUAAPLUS0378331005X", "EQUMSFTUS5949181045X", "CURUSDXUSDXXXXXXXXXX",
                   "CURGBPXUSDXXXXXXXXXX", None, None]
    ok = [r.v for r in df.select(valid_isin(F.col("h")).alias("v")).collect()]
    assert ok[:2] == [True, True] and ok[4] is False


def test_g4_unknown_external_id_maps_to_null(spark):
    from marketframe.plans.schedule import get_iid_mapping
    identifiers = spark.createDataFrame([("EQUAAPLUS0378331005X", "YAHOO", "AAPL")], S.IDENTIFIERS)
    req = spark.createDataFrame([("AAPL",), ("madeup",)], "ext_id string")
    got = {r.ext_id: r.instrument_id for r in get_iid_mapping(req, identifiers, "YAHOO").collect()}
    assert got == {"AAPL": "EQUAAPLUS0378331005X", "madeup": None}


def test_portfolio_hash_id(spark):
    import hashlib
    from marketframe.functions.ids import create_instrument_id
    df = spark.createDataFrame([("portfolio", "main", "My Pf")], "ac string, code string, h string")
    got = df.select(create_instrument_id(F.col("ac"), F.col("code"), F.col("h")).alias("i")).first().i
    assert got == "PFXMAIN" + hashlib.md5(b"MY PF").hexdigest()[:13].upper()
