"""Cleaning rules on hand-made edge rows (nulls, bad text, accents, repeats)."""
from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

from emporium.plans import clean as C
from emporium.plans.clean import CleanOptions
from emporium.schema import SOURCE_SCHEMAS


def src(spark, name, rows):
    return spark.createDataFrame(rows, SOURCE_SCHEMAS[name])


def test_products_filters_translation_and_rounding(spark):
    prod = src(spark, "products", [
        ("p1", "cat_a", "10", "20", "1", "500", "10.5", "3", "4"),
        ("p2", None, "10", "20", "1", "500", "10", "3", "4"),       # null category -> dropped
        ("p3", "cat_a", "10", "20", "1", None, "10", "3", "4"),       # null weight -> dropped
        ("p4", "cat_a", "10", "20", "1", "0", "10", "3", "4"),        # weight 0 -> dropped
        ("p5", "pc_gamer", "10", "20", "1", "100", "10", "3", "4"),   # translated by the appended row
        ("p6", "cat_unknown", "10", "20", "1", "100", "10", "3", "4"),  # untranslated, kept
    ])
    trans = src(spark, "product_category_translation",
                [("cat_a", "first"), ("cat_a", "second"), ("pc_gamer", "from_file")])
    out = {r.product_id: r for r in C.clean_products(prod, trans).collect()}
    assert set(out) == {"p1", "p5", "p6"}
    assert out["p1"].product_category_name_english == "first"       # first file row wins
    assert out["p5"].product_category_name_english == "from_file"   # file rows beat appended rows
    assert out["p6"].product_category_name_english is None
    assert out["p1"].product_length_cm == 11                         # 10.5 rounds half up
    assert [r.product_category_name for r in
            C.untranslated_categories(C.filtered_products(prod), trans).collect()] == ["cat_unknown"]


def test_products_median_imputation(spark):
    prod = src(spark, "products", [
        ("p1", "c", "1", "1", "1", "100", "10", "3", "4"),
        ("p2", "c", "1", "1", "1", "300", "10", "3", "4"),
        ("p3", "c", "1", "1", "1", None, "10", "3", "4"),
    ])
    trans = src(spark, "product_category_translation", [("c", "c_en")])
    assert C.clean_products(prod, trans).count() == 2
    imputed = {r.product_id: r.product_weight_g
               for r in C.clean_products(prod, trans, CleanOptions(impute="median")).collect()}
    assert imputed == {"p1": 100, "p2": 300, "p3": 200}


def test_sellers_city_rules(spark):
    sel = src(spark, "sellers", [("s1", "01037", " São Paulo - SP ", "SP"),
                                 ("s2", "2", "sao paulo / rio de janeiro", "RJ"),
                                 ("s3", "3", "SAO MIGUEL", "SC"), ("s4", "4", None, "SP")])
    out = {r.seller_id: r for r in C.clean_sellers(sel).collect()}
    assert out["s1"].seller_city == "sao paulo" and out["s1"].seller_zip_code_prefix == "01037"
    assert out["s2"].seller_city == "rio de janeiro"
    assert out["s3"].seller_city == "sao miguel d'oeste"
    assert out["s4"].seller_city is None
    legacy = {r.seller_id: r for r in C.clean_sellers(sel, CleanOptions(legacy_nan=True, legacy_zip=True)).collect()}
    assert legacy["s4"].seller_city == "nan" and legacy["s1"].seller_zip_code_prefix == "1037"


ORDERS = [
    # id, customer, status, purchase, approved, carrier, delivered, estimated
    ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "2018-01-02 00:00:00",
     "2018-01-05 00:00:00", "2018-01-10 00:00:00"),
    ("o2", "c1", "delivered", "2018-01-01 10:00:00", "2017-12-31 10:00:00", "2018-01-02 00:00:00",
     "2018-01-05 00:00:00", "2018-01-10 00:00:00"),   # approved < purchase, delivered -> dropped when enforced
    ("o3", "c2", "shipped", "2018-01-01 10:00:00", "2017-12-31 10:00:00", None, None,
     "2018-01-10 00:00:00"),                          # violation but not delivered -> kept
    ("o4", "c2", "delivered", "not a date", None, None, None, None),
    ("o5", "c3", "canceled", "2018-01-01 10:00:00", None, None, None, "2018-01-10 00:00:00"),
]


def test_orders_chronology_and_undefined_payments(spark):
    orders = src(spark, "orders", ORDERS)
    pays = src(spark, "order_payments", [("o5", "1", "not_defined", "1", "10.00"),
                                         ("o1", "1", "boleto", "1", "10.00"),
                                         ("o1", "2", None, "1", "5.00")])
    parity = {r.order_id: r for r in C.clean_orders(orders, pays).collect()}
    assert set(parity) == {"o1", "o2", "o3", "o4"}
    assert parity["o4"].order_purchase_timestamp is None
    assert parity["o1"].order_approved_at == datetime(2018, 1, 1, 11)
    strict = {r.order_id for r in C.clean_orders(orders, pays, CleanOptions(enforce_chronology=True)).collect()}
    assert strict == {"o1", "o3", "o4"}
    p = C.clean_payments(pays).collect()
    assert sorted((r.order_id, r.payment_sequential, r.payment_type) for r in p) == \
        [("o1", 1, "bank_slip"), ("o1", 2, None)]
    assert p[0].payment_value == Decimal("10.00")


def test_reviews_first_in_file_order_and_accents(spark):
    rows = [("r1", "o3", "5", "Ótimo", "Entrega rápida", "2018-01-02 00:00:00", "2018-01-03 00:00:00", 30),
            ("r1", "o1", "1", "x", "y", "2018-01-02 00:00:00", "2018-01-03 00:00:00", 10),
            ("r1", "o2", "2", "x", "y", "bad", "2018-01-03 00:00:00", 20),
            (None, "o4", "3", None, "½ kg", None, None, 40),
            (None, "o5", "4", None, None, None, None, 50)]
    schema = T.StructType(SOURCE_SCHEMAS["order_reviews"].fields + [T.StructField("src_ord", T.LongType())])
    raw = spark.createDataFrame(rows, schema).repartition(3)
    out = {r.review_id: r for r in C.clean_reviews(raw).collect()}
    assert set(out) == {"r1", None}
    assert out["r1"].order_id == "o1"
    assert out[None].order_id == "o4" and out[None].review_comment_message == "1⁄2 kg"
    assert out[None].review_comment_title is None
    accents = C.clean_reviews(raw.where("review_id = 'r1' AND src_ord = 30")).first()
    assert (accents.review_comment_title, accents.review_comment_message) == ("Otimo", "Entrega rapida")
    legacy = C.clean_reviews(raw, CleanOptions(legacy_nan=True)).where("review_id IS NULL").first()
    assert legacy.review_comment_title == "nan"


def test_fact_filters_fill_and_orphans(spark):
    items = src(spark, "order_items", [
        ("o1", "1", "p1", "s1", "2018-01-05 00:00:00", "10.50", "2.00"),
        ("o1", "x", "p1", "s1", "2018-01-05 00:00:00", "5.00", "0"),     # text item id -> 0
        ("o1", "3", "p1", "s1", "bad date", "0", "1.00"),                 # price 0 -> dropped
        ("o1", "4", "p1", "s1", None, "-1", "1.00"),                      # negative price
        ("o1", "5", "p1", "s1", None, None, "1.00"),                      # null price
        ("o1", "6", "p1", "s1", None, "3.00", "-1"),                      # negative freight
        ("o9", "1", "p1", "s1", None, "3.00", "1.00"),                    # orphan order
        ("o1", "7", "p9", "s1", None, "3.00", "1.00"),                    # orphan product
        ("o1", "8", "p1", "s9", None, "3.00", "1.00"),                    # orphan seller
    ])
    orders = spark.createDataFrame([("o1",)], "order_id string")
    products = spark.createDataFrame([("p1",)], "product_id string")
    sellers = spark.createDataFrame([("s1",)], "seller_id string")
    out = sorted((r.order_item_id, r.price, r.freight_value) for r in
                 C.clean_order_items(items, orders, products, sellers).collect())
    assert out == [(0, Decimal("5.00"), Decimal("0.00")), (1, Decimal("10.50"), Decimal("2.00"))]
