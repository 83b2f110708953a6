import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.plans.ingest import ingest
from martloom.sources.files import INPUT_ORDER, read_csv_text, with_input_order
from martloom.sources.jdbc import hex_bounds, range_predicates
from martloom.specs import CATEGORY_TRANSLATION, CUSTOMERS, ORDER_REVIEWS, SOURCE_TABLES


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_bom_and_crlf(spark, tmp_path):
    text = "﻿product_category_name,product_category_name_english\r\nbebes,baby\r\ncool,\r\n"
    path = put(tmp_path / "tr.csv", text)
    found = read_csv_text(spark, path, CATEGORY_TRANSLATION).collect()
    assert [tuple(r) for r in found] == [("bebes", "baby"), ("cool", None)]


REVIEW_HEADER = ",".join(ORDER_REVIEWS.columns)


def test_quoted_fields(spark, tmp_path):
    row = 'r1,o1,5,"a, ""b""","line one\nline two",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
    path = put(tmp_path / "reviews.csv", f"{REVIEW_HEADER}\n{row}")
    found = read_csv_text(spark, path, ORDER_REVIEWS).first()
    assert found.review_comment_title == 'a, "b"'
    assert found.review_comment_message == "line one\nline two"


def test_crlf_inside_a_quoted_field(spark, tmp_path):
    row = 'r1,o1,5,t,"one\r\ntwo",2018-01-01 00:00:00,2018-01-02 10:00:00\r\n'
    path = put(tmp_path / "reviews.csv", f"{REVIEW_HEADER}\r\n{row}")
    found = read_csv_text(spark, path, ORDER_REVIEWS, line_sep="\r\n").first()
    assert found.review_comment_message == "one\r\ntwo"


def test_crlf_records_with_inner_lf_are_split(spark, tmp_path):
    rows = "".join(
        f'r{i},o1,5,t,"one\ntwo, ""{i}""",2018-01-01 00:00:00,\r\n' for i in range(3000)
    )
    path = put(tmp_path / "reviews.csv", f"{REVIEW_HEADER}\r\n{rows}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    try:
        df = read_csv_text(spark, path, ORDER_REVIEWS, multi_line=False, line_sep="\r\n")
        assert df.rdd.getNumPartitions() > 4
        found = {r.review_id: r.review_comment_message for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {f"r{i}": f'one\ntwo, "{i}"' for i in range(3000)}


def test_a_short_row_is_filled_and_a_long_one_fails(spark, tmp_path):
    head = ",".join(CUSTOMERS.columns)
    short = put(tmp_path / "c.csv", f"{head}\n1,2,3\n")
    assert tuple(read_csv_text(spark, short, CUSTOMERS).first()) == ("1", "2", "3", None, None)
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv_text(spark, short, CUSTOMERS, mode="FAILFAST").collect()
    for surplus in ("1,2,3,4,5,6", "1,2,3,4,5,", '1,2,"3,3",4,5,,'):
        long = put(tmp_path / f"{len(surplus)}.csv", f"{head}\n1,2,3,4,5\n{surplus}\n")
        with pytest.raises(Exception, match="row too long"):
            read_csv_text(spark, long, CUSTOMERS).select("customer_id").collect()
        assert read_csv_text(spark, long, CUSTOMERS, mode="PERMISSIVE").count() == 2
    exact = put(tmp_path / "e.csv", f'{head}\n1,2,"3,3",4,\n')
    assert tuple(read_csv_text(spark, exact, CUSTOMERS).first()) == ("1", "2", "3,3", "4", None)


def test_wrong_header_fails(spark, tmp_path):
    path = put(tmp_path / "c.csv", "customer_id,a,b,c,d\n1,2,3,4,5\n")
    with pytest.raises(Exception, match="header|schema"):
        read_csv_text(spark, path, CUSTOMERS).collect()


def test_markers_even_when_quoted(spark, tmp_path):
    head = ",".join(CUSTOMERS.columns)
    path = put(tmp_path / "c.csv", f'{head}\n001,"NA",01037,"",null\n')
    assert tuple(read_csv_text(spark, path, CUSTOMERS).first()) == ("001", None, "01037", None, None)


def test_input_order_follows_file_and_line(spark, tmp_path):
    head = ",".join(CUSTOMERS.columns)
    for name, ids in (("b.csv", "12"), ("a.csv", "9876543")):
        put(tmp_path / "in" / name, head + "\n" + "".join(f"{i},u,z,c,s\n" for i in ids))
    df = read_csv_text(spark, str(tmp_path / "in"), CUSTOMERS, keep_order=True)
    shuffled = df.repartition(5).orderBy(INPUT_ORDER)
    assert [r.customer_id for r in shuffled.collect()] == list("987654312")


def test_input_order_of_a_split_file(spark, tmp_path):
    head = ",".join(CUSTOMERS.columns)
    put(tmp_path / "big.csv", head + "\n" + "".join(f"{i:07d},u,z,c,s\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    try:
        df = read_csv_text(spark, str(tmp_path / "big.csv"), CUSTOMERS, keep_order=True)
        assert df.rdd.getNumPartitions() > 4
        ids = [r.customer_id for r in df.repartition(7).orderBy(INPUT_ORDER).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids == [f"{i:07d}" for i in range(20000)]


def test_input_order_of_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000).coalesce(1).write.parquet(path)
    df = with_input_order(spark.read.parquet(path))
    assert [r.id for r in df.repartition(4).orderBy(INPUT_ORDER).collect()] == list(range(1000))


def csv_tables(tmp_path):
    texts = {
        "geolocations": "01,-23.50,-46.60,a,SP\n02,-23.5,-46.6,b,SP\n01,-23.51,-46.6,c,SP\n",
        "product_category_name_translation": "bebes,baby\nauto,auto\n",
        "customers": "c1,u1,01037,sao paulo,SP\n",
        "sellers": "s1,01037,sao paulo,SP\n",
        "products": "p1,bebes,10,20.0,1,100,10,10,10\np2,,1,1,1,1,1,1,1\np3,nowhere,1,1,1,1,1,1,1\n"
        "p4,auto,,x,NaN,5,5,5,5\n",
        "orders": "o1,c1,delivered,2017-09-19 09:45:35,2017-09-19,,junk,2017-10-01 00:00:00\n"
        "o2,c1,shipped,2017-09-20 00:00:00,,,,\n",
        "order_items": "o1,1,p1,s1,2017-09-19 09:45:35,58.90,13.29\n"
        "o1,2,p2,s1,2017-09-19 09:45:35,1,1\no2,1,p3,s1,2017-09-19 09:45:35,1,1\n"
        "o2,2,p4,s1,junk,1.5,2\n",
        "order_payments": "o1,1,boleto,1,72.19\no2,1,credit_card,3,2.5\n",
        "order_reviews": 'r1,o1,5,,"first\nline",2018-01-01 00:00:00,\n'
        "r1,o2,1,again,second,2018-01-01 00:00:00,\nr2,o2,4,t,m,2018-01-01 00:00:00,\n",
    }
    return {
        name: put(tmp_path / f"{name}.csv", ",".join(SOURCE_TABLES[name].columns) + "\n" + text)
        for name, text in texts.items()
    }


def test_ingest(spark, tmp_path):
    clean = ingest(spark, csv_tables(tmp_path))
    for name, df in clean.items():
        spec = SOURCE_TABLES[name]
        assert [(f.name, f.dataType) for f in df.schema] == list(spec.types.items()), name
    assert sorted(tuple(r) for r in clean["geolocations"].collect()) == [
        ("01", -23.51, -46.6, "c", "SP"),
        ("01", -23.5, -46.6, "a", "SP"),
    ]
    products = {r.product_id: r for r in clean["products"].collect()}
    assert sorted(products) == ["p1", "p4"]
    assert tuple(products["p1"])[2:] == (10, 20, 1, 100, 10, 10, 10)
    assert tuple(products["p4"])[2:] == (None, None, None, 5, 5, 5, 5)
    items = {(r.order_id, r.order_item_id): r for r in clean["order_items"].collect()}
    assert sorted(items) == [("o1", 1), ("o2", 2)]
    assert items["o1", 1].price == 58.9 and items["o2", 2].shipping_limit_date is None
    orders = {r.order_id: r for r in clean["orders"].collect()}
    assert orders["o1"].order_purchase_timestamp == dt.datetime(2017, 9, 19, 9, 45, 35)
    assert orders["o1"].order_approved_at is None
    assert orders["o1"].order_delivered_customer_date is None
    assert clean["order_payments"].count() == 2
    reviews = {r.review_id: r for r in clean["order_reviews"].collect()}
    assert sorted(reviews) == ["r1", "r2"]
    assert reviews["r1"].review_comment_message == "first\nline"
    assert reviews["r1"].review_comment_title is None


def test_first_review_is_that_of_the_first_file(spark, tmp_path):
    for name, text in (("b.csv", "late"), ("a.csv", "early")):
        row = f"r1,o1,5,t,{text},2018-01-01 00:00:00,\n"
        put(tmp_path / "reviews" / name, f"{REVIEW_HEADER}\n{row}")
    clean = ingest(spark, {"order_reviews": str(tmp_path / "reviews")})["order_reviews"]
    assert [r.review_comment_message for r in clean.collect()] == ["early"]


def test_bad_price_fails_the_load(spark, tmp_path):
    paths = csv_tables(tmp_path)
    head = ",".join(SOURCE_TABLES["order_items"].columns)
    paths["order_items"] = put(tmp_path / "bad.csv", f"{head}\no1,1,p1,s1,,abc,1\n")
    with pytest.raises(Exception, match="not a number: abc"):
        ingest(spark, paths)["order_items"].collect()


@pytest.mark.parametrize("bounds", [[], ["8"], hex_bounds(16), ["it's", "b", "b"]])
def test_predicates_hold_every_row_once(spark, bounds):
    ids = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    ids = ids.union(spark.createDataFrame([(None,), ("",), ("it's",), ("b",), ("zz",)], "k string"))
    predicates = range_predicates("k", bounds)
    assert sum(ids.where(p).count() for p in predicates) == 3005
    assert len(predicates) == len(set(bounds)) + 1


def test_hex_bounds_are_even():
    assert hex_bounds(4) == ["4000", "8000", "c000"]
