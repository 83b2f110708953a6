import datetime as dt
from decimal import Decimal

import pytest

from checks import standins, star_queries
from martloom.operators import keys
from martloom.operators.quality import check_table, key_violations
from martloom.plans import star
from martloom.plans.ingest import ingest
from martloom.shared import written
from martloom.specs import STAR_TABLES
from test_sources_ingest import csv_tables


def found(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=repr)


PRODUCT = (
    "product_id string, product_category_name string, product_weight_g int,"
    " product_length_cm int, product_height_cm int, product_width_cm int"
)
NAMES = "product_category_name string, product_category_name_english string"


@pytest.fixture
def names(rows):
    return rows([("c", "C"), ("d", None)], NAMES)


def test_dim_product_filters(rows, names):
    measures = [(1, 1, 1, 1)] + [
        tuple(bad if i == at else 1 for i in range(4)) for at in range(4) for bad in (None, 0, -1)
    ]
    products = rows([(f"p{i:02d}", "c", *m) for i, m in enumerate(measures)], PRODUCT)
    products = products.union(rows([("q1", "d", 1, 1, 1, 1), ("q2", "x", 1, 1, 1, 1)], PRODUCT))
    dim = star.build_dim_product(products, names)
    assert dim.dtypes == [
        (c, t.simpleString()) for c, t in STAR_TABLES["dim_product"].types.items()
    ]
    assert found(dim) == [(1, "p00", "C", "c", 1, 1, 1, 1, 1, 1.0)]


def test_dim_product_twice(rows, names):
    first = star.build_dim_product(rows([("b", "c", 8, 2, 2, 2), ("c", "c", 1, 1, 1, 1)], PRODUCT), names)
    batch = rows([("b", "c", 8, 4, 2, 2), ("a", "c", 6, 1, 2, 3)], PRODUCT)
    second = star.build_dim_product(batch, names, existing=first)
    columns = ("product_key", "product_id", "product_volume_cm3", "product_density_g_per_cm3")
    expected = [(1, "b", 16, 0.5), (2, "c", 1, 1.0), (3, "a", 6, 1.0)]
    assert found(second, *columns) == expected
    assert found(star.build_dim_product(batch, names, existing=second), *columns) == expected


def test_dim_product_repeated_key_fails(rows, names):
    batch = rows([("a", "c", 1, 1, 1, 1), ("a", "c", 2, 1, 1, 1)], PRODUCT)
    with pytest.raises(Exception, match="key given twice"):
        star.build_dim_product(batch, names)


def test_dim_customer_twice(rows):
    schema = (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string,"
        " customer_city string, customer_state string"
    )
    first = star.build_dim_customer(rows([("b", "u", "1", "x", "S"), ("c", "u", "1", None, "S")], schema))
    assert found(first) == [(1, "b", "u", "1", "x", "S")]
    batch = rows(
        [("b", "u", "1", "moved", "S"), ("a", "u", "2", "y", "S"), ("a", "u", "1", "y", "S")], schema
    )
    second = star.build_dim_customer(batch, existing=first)
    assert found(second) == [(1, "b", "u", "1", "x", "S"), (2, "a", "u", "1", "y", "S")]


def test_dim_geolocation_twice_doubles(rows):
    schema = (
        "geolocation_zip_code_prefix string, geolocation_city string, geolocation_state string,"
        " geolocation_lat double, geolocation_lng double"
    )
    places = rows([("1", "a", "S", 1.0, None)] * 2 + [("1", None, "S", 1.0, 1.0)], schema)
    first = star.build_dim_geolocation(places)
    assert found(first) == [(1, "1", "a", "S", 1.0, None)]
    second = star.build_dim_geolocation(places, existing=first)
    assert found(second, "geolocation_key") == [(1,), (2,)]


@pytest.mark.parametrize(
    "day, expected",
    [
        (dt.date(2016, 12, 31), (20161231, 2016, 52, 6)),
        (dt.date(2017, 1, 1), (20170101, 2016, 52, 7)),
        (dt.date(2018, 12, 31), (20181231, 2019, 1, 1)),
        (dt.date(2020, 2, 29), (20200229, 2020, 9, 6)),
        (dt.date(2020, 12, 31), (20201231, 2020, 53, 4)),
    ],
)
def test_calendar_edges(spark, day, expected):
    calendar = star.build_dim_time(spark, day, day)
    assert found(calendar, "date_id", "year", "week_of_year_iso", "day_of_week") == [expected]


def test_calendar_ranges(spark, rows):
    start = dt.date(2019, 12, 30)
    assert star.build_dim_time(spark, start, dt.date(2020, 1, 2)).count() == 4
    empty = star.build_dim_time(spark, start, dt.date(2019, 12, 29))
    assert empty.count() == 0
    assert dict(empty.dtypes) == {
        c: t.simpleString() for c, t in STAR_TABLES["dim_time"].types.items()
    }
    assert star.build_dim_time_of(rows([(None,)], "d date"), "d").count() == 0


@pytest.fixture
def built(spark, tmp_path):
    tables = ingest(spark, csv_tables(tmp_path))
    return tables, star.build_star(tables)


def test_star_from_csv(built):
    tables, mart = built
    assert set(mart) == set(STAR_TABLES)
    for name, df in mart.items():
        assert df.dtypes == [(c, t.simpleString()) for c, t in STAR_TABLES[name].types.items()]
        assert key_violations(df, STAR_TABLES[name].key).count() == 0
        report = check_table(df, STAR_TABLES[name], mart)
        assert report.where("n_violations > 0").count() == 0, name
    assert found(mart["fact_order_item"]) == [
        (1, "o1", 1, 1, 1, 1, 1, Decimal("58.90"), Decimal("13.29")),
        (2, "o2", 2, 2, 1, 1, 2, Decimal("1.50"), Decimal("2.00")),
    ]
    assert mart["dim_time"].count() == 2


def test_star_refresh_keeps_keys(built):
    tables, first = built
    second = star.build_star(tables, existing=first)
    for name in set(STAR_TABLES) - {"dim_geolocation"}:
        assert found(second[name]) == found(first[name]), name
    assert second["dim_geolocation"].count() == 2 * first["dim_geolocation"].count()


def test_fact_refresh(built, rows):
    tables, mart = built
    schema = tables["order_items"].schema.simpleString()[7:-1].replace(":", " ")
    batch = rows(
        [("o2", 2, "p4", "s1", None, 9.99, 2.0), ("o1", 0, "p1", "s1", None, 1.0, 0.0)], schema
    )
    first = mart["fact_order_item"]
    second = star.build_fact_order_item(batch, tables["orders"], mart, existing=first)
    columns = ("order_item_fact_key", "order_id", "order_item_id", "item_price")
    assert found(second, *columns) == [
        (1, "o1", 1, Decimal("58.90")),
        (2, "o2", 2, Decimal("9.99")),
        (3, "o1", 0, Decimal("1.00")),
    ]


def test_lines_are_looked_up_once_per_refresh(spark, built):
    tables, mart = built
    ran = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    items = tables["order_items"]
    counted = items.mapInArrow(seen, items.schema)
    again = star.build_fact_order_item(
        counted, tables["orders"], mart, existing=mart["fact_order_item"]
    )
    assert again.count() == items.count()
    assert ran.value == items.count()


def _fact(rows, data):
    schema = (
        "order_item_fact_key long, order_id string, order_item_id int, product_key int, customer_key int,"
        " seller_key int, order_status_key int, item_price decimal(12,2), freight_value decimal(12,2)"
    )
    return rows([(k, o, i, *keys, *map(_money, sums)) for k, o, i, keys, sums in data], schema)


def _money(text):
    return None if text is None else Decimal(text)


def test_numbered_lines_take_all_values_of_the_newer_run(rows):
    """A value that is NULL in the newer run replaces the older one; lines of one run only stay."""
    old = _fact(rows, [(1, "a", 1, (1, 1, 1, 1), ("5", "6")), (2, "a", 2, (1, 1, 1, 1), ("7", "8"))])
    new = _fact(
        rows, [(None, "a", 2, (2, 3, 4, 5), (None, "1")), (None, "0", 1, (1, 1, 1, 1), ("2", "2"))]
    ).drop("order_item_fact_key")
    got = star.number_lines(new, old)
    assert got.dtypes == old.dtypes
    assert found(got) == [
        (1, "a", 1, 1, 1, 1, 1, Decimal("5.00"), Decimal("6.00")),
        (2, "a", 2, 2, 3, 4, 5, None, Decimal("1.00")),
        (3, "0", 1, 1, 1, 1, 1, Decimal("2.00"), Decimal("2.00")),
    ]


def test_refresh_writes_each_line_once_per_step(rows, monkeypatch):
    """The joined lines hold one value of each column; the new ones among them are not copied."""
    kept = {}

    def noted(df, purpose):
        assert purpose not in kept
        kept[purpose] = df.columns
        return written(df, purpose)

    monkeypatch.setattr(star, "written", noted)
    monkeypatch.setattr(keys, "written", noted)
    fact = _fact(rows, [(1, "a", 1, (1, 1, 1, 1), ("5", "6")), (2, "b", 1, (1, 1, 1, 1), ("7", "8"))])
    again = star.number_lines(fact.drop("order_item_fact_key"), fact.where("order_id = 'a'"))
    assert [r[:2] for r in found(again)] == [(1, "a"), (2, "b")]
    assert kept == {"lines": fact.columns, "keys": [*fact.columns[1:], "_slot"]}


def test_runs_of_the_refresh_query_share_their_lookups(spark, monkeypatch):
    """Two runs over the same tables read and reduce the order lines once."""
    ran, given = spark.sparkContext.accumulator(0), standins.order_items_raw

    def seen(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    def counted(spark, sf_dir):
        lines = given(spark, sf_dir)
        return lines.mapInArrow(seen, lines.schema)

    monkeypatch.setattr(standins, "order_items_raw", counted)
    folder = "/root/testdata/sf0.001"
    star_queries.fact_refresh(spark, folder).collect()
    assert ran.value == given(spark, folder).count()


def test_keys_of_dimensions_may_be_long(rows):
    customers = rows(
        [("c1", "u", "z", "c", "s")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string,"
        " customer_city string, customer_state string",
    )
    assert dict(star.build_dim_customer(customers, key_type="long").dtypes)["customer_key"] == "bigint"


def test_fact_lines_without_match(built, rows):
    tables, mart = built
    extra = rows(
        [("o1", 9, "none", "s1", None, 1.0, 1.0), ("gone", 1, "p1", "nobody", None, 1.0, 1.0)],
        tables["order_items"].schema.simpleString()[7:-1].replace(":", " "),
    )
    items = tables["order_items"].union(extra)
    assert star.build_fact_order_item(items, tables["orders"], mart).count() == 2
    rejects = star.fact_rejects(items, tables["orders"], mart)
    assert found(rejects) == [
        ("gone", 1, ["customer_key", "seller_key", "order_status_key"]),
        ("o1", 9, ["product_key"]),
    ]
    unknown = star.build_fact_order_item(items, tables["orders"], mart, on_missing="unknown")
    keys = ("order_id", "order_item_id", "product_key", "customer_key", "seller_key")
    assert ("gone", 1, 1, -1, -1) in found(unknown, *keys)
    assert unknown.count() == 4
