"""Staging, dimensions, fact and storage on hand-made extracts."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from orderloom.operators.dedup import repeated_key_hashes
from orderloom.plans import dimensions, fact, profile, quality, reports, staging
from orderloom.plans.vocabulary import STATUSES
from orderloom.plans.warehouse import Warehouse
from orderloom.sources import csvfiles, schemas, tables
from tests.conftest import DEFAULTS, SMALL

NO_ADDRESS = {"ship-city": None, "ship-state": None, "ship-postal-code": None, "ship-country": None}


def built(spark, tmp_path, raw, **options):
    w = Warehouse(spark, str(tmp_path / "wh"), raw=lambda: raw, **options)
    w.build()
    return w


def test_staging_types_and_measures(raw_rows):
    rows = raw_rows(
        {"Order ID": " o1 ", "SKU": "k1 ", "promotion-ids": " a,b ", "B2B": "TRUE"},
        {"Order ID": "o2", "Status": "Cancelled", "Amount": "5", "promotion-ids": " "},
        {"Order ID": "o3", "Status": None, "Amount": "bad", "Qty": "2.5", "Date": "x"},
    )
    found = {r["order_id"]: r for r in staging.staged_lines(rows).collect()}
    assert found["o1"]["ship_city"] == "MUMBAI" and found["o1"]["ship_city_raw"] == "mumbai"
    assert found["o1"]["ship_postal_code"] == "400081"
    assert found["o1"]["order_date"] == dt.date(2022, 4, 30)
    assert (found["o1"]["promo_count"], found["o1"]["is_b2b"]) == (2, True)
    assert (found["o2"]["is_cancelled"], found["o2"]["revenue_amount"]) == (True, Decimal("0.00"))
    assert (found["o2"]["promotion_ids_raw"], found["o2"]["promo_count"]) == (None, 0)
    assert (found["o3"]["is_cancelled"], found["o3"]["amount"], found["o3"]["quantity"]) == (None, None, 3)
    assert found["o3"]["order_date"] is None


def test_dedup_prefers_an_amount_then_the_latest(raw_rows):
    rows = raw_rows(
        {"Order ID": "a", "index": "9", "Amount": None},
        {"Order ID": "a", "index": "3", "Amount": "5.00"},
        {"Order ID": "b", "index": "3", "Amount": "5.00"},
        {"Order ID": " b", "index": "4", "Amount": "6.00"},
        {"Order ID": None, "index": "1"},
        {"Order ID": None, "index": "2"},
        {"Order ID": "c", "index": "bad", "Qty": "7"},
        {"Order ID": "c", "index": "0", "Qty": "8"},
    )
    found = {r["order_id"]: r for r in staging.staged_lines(rows).collect()}
    assert len(found) == 4
    assert found["a"]["amount"] == Decimal("5.00")
    assert found["b"]["amount"] == Decimal("6.00")
    assert found["c"]["quantity"] == 8


def test_dedup_of_a_hot_key_matches_brute_force_and_is_repeatable(spark, raw_rows):
    pick = random.Random(3)
    rows = [
        {
            "Order ID": "hot" if i % 3 == 0 else f"o{pick.randint(0, 400)}",
            "SKU": "k",
            "index": str(pick.randint(0, 50)),
            "Amount": pick.choice([None, "1", "2"]),
            "Qty": str(pick.randint(0, 99)),
        }
        for i in range(6000)
    ]
    kept = {}
    for row in rows:
        full = [{**DEFAULTS, **row}[c] for c in schemas.RAW_COLUMNS]
        rank = (row["Amount"] is None, -int(row["index"]), [(v is None, v or "") for v in full])
        key = row["Order ID"]
        if key not in kept or rank < kept[key][0]:
            kept[key] = (rank, row["Qty"])
    wanted = {key: int(q) for key, (_, q) in kept.items()}
    for parts, narrowed in ((1, False), (7, False), (7, True)):
        raw = raw_rows(*rows).repartition(parts)
        repeated = repeated_key_hashes(raw, staging.line_key()) if narrowed else None
        staged = staging.staged_lines(raw, repeated)
        assert {r["order_id"]: r["quantity"] for r in staged.collect()} == wanted


@pytest.mark.parametrize("limit", [0, 100])
def test_repeated_lines_beyond_the_limit_are_not_broadcast(spark, tmp_path, raw_rows, limit):
    rows = [{"Order ID": "a", "index": "1"}, {"Order ID": "a", "index": "2"}, {"Order ID": "b"}, {"Order ID": None, "SKU": None}]
    w = Warehouse(spark, str(tmp_path / "wh"), raw=lambda: raw_rows(*rows), broadcast_rows=limit)
    assert w.staging().count() == 3
    assert w.rows_written["repeated_lines"] == 1
    assert profile.exact_duplicates(w.raw(), w.repeated_lines(), limit).first()[0] == 1


def test_default_calendar(spark):
    days = dimensions.calendar(spark)
    assert days.count() == 4018
    sunday = days.where("full_date = date'2022-05-29'").first()
    assert (sunday["day_of_week"], sunday["day_name"], sunday["month_name"]) == (0, "Sunday", "May")
    assert (sunday["quarter"], sunday["season"], sunday["is_weekend"], sunday["date_key"]) == (2, "Summer", True, 20220529)
    new_year = days.where("full_date = date'2022-01-01'").first()
    assert (new_year["week_of_year"], new_year["season"]) == (52, "Winter")
    ends = days.agg(F.min("full_date"), F.max("full_date")).first()
    assert tuple(ends) == (dt.date(2020, 1, 1), dt.date(2030, 12, 31))


def test_product_attributes_are_picked_independently(raw_rows):
    rows = raw_rows(
        {"Order ID": "1", "ASIN": "a", "Style": "z"},
        {"Order ID": "2", "ASIN": "b", "Style": "y"},
        {"Order ID": "3", "ASIN": None, "Style": None},
    )
    products = dimensions.products(staging.staged_lines(rows)).collect()
    assert [(p["sku"], p["asin"], p["product_style"]) for p in products] == [("k1", "b", "z")]


def test_line_without_city_is_lost_and_reported(spark, tmp_path, raw_rows):
    rows = raw_rows({"Order ID": "full"}, {"Order ID": "cityless", "ship-city": None}, {"Order ID": "none", **NO_ADDRESS})
    w = built(spark, tmp_path, rows)
    found = {r["order_id"]: r for r in w.fact().collect()}
    assert set(found) == {"full", "none"}
    unknown = w.places().where("ship_city = 'UNKNOWN'").collect()
    assert [p["region"] for p in unknown] == ["Unknown"]
    assert found["none"]["geography_key"] == unknown[0]["geography_key"]
    assert found["none"]["ship_country"] is None
    mismatch = quality.fact_count_mismatch(w.star(), w.staging()).collect()
    assert [tuple(r) for r in mismatch] == [(2, 3, -1)]


def line_mix():
    """Address fields present, missing or reading UNKNOWN, in all mixes, with and without a literal UNKNOWN."""
    fields = ["ship-city", "ship-state", "ship-postal-code", "ship-country"]
    for mask in range(16):
        yield {f: (None if mask >> i & 1 else DEFAULTS[f]) for i, f in enumerate(fields)}


@pytest.mark.parametrize("literal", [False, True])
def test_derived_keys_equal_looked_up_keys(spark, tmp_path, raw_rows, literal):
    rows = [{"Order ID": f"o{i}", **address} for i, address in enumerate(line_mix())]
    rows += [{"Order ID": "no sku", "SKU": None}, {"Order ID": "late", "Date": "01-01-35"}, {"Order ID": "odd", "Status": "?"}]
    if literal:
        rows.append({"Order ID": "named unknown", "ship-city": "unknown"})
    w = built(spark, tmp_path, raw_rows(*rows), calendar=("2020-01-01", "2031-01-01"))
    looked_up = fact.fact_by_lookup(w.staging(), w.dates(), w.products(), w.places(), w.statuses())
    assert Counter(map(tuple, w.fact().collect())) == Counter(map(tuple, looked_up.collect()))
    assert fact.named_unknown(w.places()).count() == (2 if literal else 1)
    kept = {r["order_id"] for r in looked_up.collect()}
    assert ("o1" in kept) is literal  # o1 lacks only its city
    assert kept >= {"o0", "o15"} and not kept & {"no sku", "late", "odd"}
    for limit in (0, 100):
        derived = fact.fact_by_key(w.staging(), w.dates(), w.places(), w.statuses(), limit)
        assert Counter(map(tuple, derived.collect())) == Counter(map(tuple, looked_up.collect()))


def test_an_address_that_reads_unknown_throughout_is_refused(spark, tmp_path, raw_rows):
    place = {c: "Unknown" for c in NO_ADDRESS}
    place["ship-postal-code"] = place["ship-country"] = "UNKNOWN"
    w = Warehouse(spark, str(tmp_path / "wh"), raw=lambda: raw_rows({"Order ID": "named", **place}, {"Order ID": "none", **NO_ADDRESS}))
    with pytest.raises(Exception, match="UNKNOWN in every field is refused; order named"):
        w.build()


def test_lines_outside_the_calendar_are_reported(spark, tmp_path, raw_rows):
    w = built(spark, tmp_path, raw_rows({"Order ID": "a"}, {"Order ID": "mistyped", "Date": "01-01-69"}))
    assert w.dates().count() == 4018 and w.fact().count() == 1
    assert [tuple(r) for r in quality.fact_count_mismatch(w.star(), w.staging()).collect()] == [(1, 2, -1)]


def test_open_reads_what_is_stored_and_builds_nothing(spark, tmp_path, raw_rows):
    calls = []
    base = str(tmp_path / "wh")

    def load():
        calls.append(1)
        return raw_rows({"Order ID": "a"}, {"Order ID": "b", "Qty": "3"})

    Warehouse(spark, base, raw=load).build()
    loads = len(calls)
    opened = Warehouse.open(spark, base)
    assert reports.style_revenue(opened.star(), "MUMBAI").first()["units"] == 4
    assert opened.raw().count() == 2 and opened.regions().count() == 36 and len(calls) == loads and not opened.rows_written
    with pytest.raises(ValueError, match="no complete table"):
        Warehouse.open(spark, str(tmp_path / "none")).fact()


def test_failed_rebuild_leaves_the_old_rows(spark, tmp_path, raw_rows):
    base = str(tmp_path / "wh")
    Warehouse(spark, base, raw=lambda: raw_rows({"Order ID": "old"})).build()
    broken = raw_rows({"Order ID": "new"}).withColumn("SKU", F.raise_error(F.lit("broken extract")).cast("string"))
    with pytest.raises(Exception, match="broken extract"):
        Warehouse(spark, base, raw=lambda: broken).build()
    assert [r["order_id"] for r in Warehouse.open(spark, base).fact().collect()] == ["old"]
    Warehouse(spark, base, raw=lambda: raw_rows({"Order ID": "new"})).build()
    assert [r["order_id"] for r in Warehouse.open(spark, base).fact().collect()] == ["new"]


def test_a_table_can_be_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "it's a table")
    schema = spark.range(1).schema
    tables.overwrite(spark.range(5), path)
    for _ in range(4):
        assert tables.overwrite(tables.read(spark, path, schema).where("id > 0"), path) == 4
    assert tables.read(spark, path, schema).count() == 4
    assert len([p for p in (tmp_path / "it's a table").iterdir() if p.is_dir()]) == 2
    tables.publish(spark, str(tmp_path / "it's"), {"quoted": {"t": (path, ["id"])}})
    assert spark.sql("SELECT count(*) FROM quoted.t").first()[0] == 4
    tables.unpublish(spark, ["quoted"])


def test_every_status_reaches_the_fact(spark, tmp_path, raw_rows):
    rows = raw_rows(*[{"Order ID": f"o{i}", "Status": s.detail} for i, s in enumerate(STATUSES)])
    w = built(spark, tmp_path, rows)
    assert w.fact().join(w.statuses(), "status_key").select("status_detail").distinct().count() == 13


def test_region_lookup_with_a_repeated_state_is_refused(spark, tmp_path, raw_rows):
    twice = spark.createDataFrame([("IN", "GOA", "West"), ("IN", "GOA", "South")], schemas.REGIONS)
    with pytest.raises(ValueError, match="twice"):
        built(spark, tmp_path, raw_rows({}), regions=lambda: twice)


def test_tables_are_written_once_and_counted(spark, tmp_path, raw_rows):
    w = built(spark, tmp_path, raw_rows({"Order ID": "a"}, {"Order ID": "a"}, {"Order ID": "b"}), fact_by_month=True)
    assert w.rows_written["order_lines"] == 3
    assert w.rows_written["stg_orders"] == w.rows_written["fct_sales"] == 2
    assert w.rows_written["state_to_region"] == 36
    assert w.fact().columns == schemas.FACT.names
    assert w.build() == w.rows_written


def test_published_names_answer_sql(spark, tmp_path, raw_rows):
    w = Warehouse(spark, str(tmp_path / "wh"), raw=lambda: raw_rows({"Qty": "4"}), fact_by_month=True)
    w.publish("pub_")
    w.publish("pub_")
    found = spark.sql(
        """
        SELECT p.product_style, sum(f.quantity) AS units, round(sum(f.revenue_amount), 2) AS revenue
        FROM pub_marts.fct_sales f
        JOIN pub_marts.dim_product p USING (product_key) JOIN pub_marts.dim_geography g USING (geography_key)
        WHERE g.region = 'West' GROUP BY p.product_style
        """
    ).collect()
    assert [tuple(r) for r in found] == [("S1", 4, Decimal("10.00"))]
    assert spark.sql("SELECT * FROM pub_staging.stg_orders").columns == schemas.STAGING.names


def test_csv_quotes_blanks_and_header(spark, tmp_path):
    (tmp_path / "in.csv").write_text('country,state,region\n"q,""z","",b\n x ,,"c"\n')
    found = csvfiles.read_regions(spark, str(tmp_path / "in.csv")).collect()
    assert [tuple(r) for r in found] == [('q,"z', None, "b"), (" x ", None, "c")]
    free = csvfiles.read_text_csv(spark, str(tmp_path / "in.csv"), schema=None)
    assert free.columns == ["country", "state", "region"] and free.count() == 2
    (tmp_path / "bad.csv").write_text("state,country,region\na,b,c\n")
    with pytest.raises(Exception, match="(?i)header"):
        csvfiles.read_regions(spark, str(tmp_path / "bad.csv")).collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_loses_no_row(spark, tmp_path, multi_line):
    lines = ["country,state,region", "a,b,c", "1,2,3,4", "1,2", '"x', 'y",s,r', 'a,b,"z', 'w"']
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "in.csv")
    with pytest.raises(csvfiles.MalformedRows, match=f"{2 if multi_line else 6} malformed rows"):
        csvfiles.read_text_csv(spark, path, schemas.REGIONS, multi_line=multi_line)
    good, bad = csvfiles.split_csv(spark, path, schemas.REGIONS, multi_line=multi_line)
    wanted = [("a", "b", "c"), ("x\ny", "s", "r"), ("a", "b", "z\nw")] if multi_line else [("a", "b", "c")]
    assert [tuple(r) for r in good.collect()] == wanted and good.count() == good.select("state").count() == len(wanted)
    diverted = lines[2:4] if multi_line else lines[2:]
    assert sorted(r[0] for r in bad.collect()) == sorted(diverted) and bad.count() == len(diverted)


def test_typed_tables_can_be_profiled(spark, tmp_path, raw_rows):
    from orderloom.operators import counting

    w = built(spark, tmp_path, raw_rows({"Order ID": "a", "Amount": "1"}, {"Order ID": "b", "Amount": "1.00", "Qty": "7"}))
    columns = ["order_date", "quantity", "amount", "is_b2b", "sku"]
    found = counting.distinct_counts(w.staging(), {c: c for c in columns}).first().asDict()
    assert found == {"order_date": 1, "quantity": 2, "amount": 1, "is_b2b": 1, "sku": 1}
    top = {(r["column_name"], r["value"]): r["count"] for r in counting.top_values(w.fact(), ["quantity", "is_cancelled"], 5).collect()}
    assert top == {("quantity", "1"): 1, ("quantity", "7"): 1, ("is_cancelled", "false"): 2}


def test_csv_keeps_line_breaks_on_request(spark, tmp_path):
    (tmp_path / "in.csv").write_text('country,state,region\n"a\nb",c,d\n')
    found = csvfiles.read_text_csv(spark, str(tmp_path / "in.csv"), schemas.REGIONS, multi_line=True).collect()
    assert [tuple(r) for r in found] == [("a\nb", "c", "d")]


def test_shared_folder_follows_the_session(spark):
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def session_stub(master):
    conf = {"spark.master": master}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
        sparkContext=SimpleNamespace(applicationId="stub"),
    )


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_folder(session_stub("yarn"))
    assert tables.shared_folder(session_stub("local[2]")) == tables.shared_folder(session_stub("local[2]"))


def test_schema_contract(spark):
    with pytest.raises(ValueError, match="unexpected schema"):
        schemas.conform(spark.range(1), schemas.FACT)


def test_benchmark_warehouse_is_reused(spark):
    from orderloom.plans.benchmark import open_benchmark

    assert open_benchmark(spark, SMALL) is open_benchmark(spark, SMALL)
