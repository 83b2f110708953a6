"""Table definitions: columns, keys, references and text limits, stated once per table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
MONEY = T.DecimalType(12, 2)
TIME = T.TimestampNTZType()
DATE = T.DateType()
FLAG = T.BooleanType()


@dataclass(frozen=True)
class Reference:
    """A foreign key: `columns` of the child point at `parent_columns` of `parent`."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    types: dict[str, T.DataType]
    key: tuple[str, ...]
    nullable: frozenset[str] = frozenset()
    references: tuple[Reference, ...] = ()
    # number columns whose bad text becomes NULL instead of failing the load
    lenient: frozenset[str] = frozenset()
    # text columns written by people: may hold line breaks, cleaned before staging
    free_text: tuple[str, ...] = ()
    limits: dict[str, int] = field(default_factory=dict)
    # patterns of timestamp columns that are not in `yyyy-MM-dd HH:mm:ss`
    formats: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return list(self.types)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.types.items()])

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, TEXT, True) for c in self.types])

    @property
    def required(self) -> list[str]:
        return [c for c in self.types if c not in self.nullable]

    @property
    def text_limits(self) -> dict[str, int]:
        """Length limit of every text column; STAGING_TEXT_LIMIT where none is stated."""
        return {
            c: self.limits.get(c, STAGING_TEXT_LIMIT) for c, t in self.types.items() if t == TEXT
        }


# --- fixed values: the operational and star tables of the retail data set ---------------------

STAGING_TEXT_LIMIT = 255

_PRODUCT_MEASURES = (
    "product_name_length",
    "product_description_length",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)

GEOLOCATIONS = TableSpec(
    "geolocations",
    dict(
        geolocation_zip_code_prefix=TEXT,
        geolocation_lat=DOUBLE,
        geolocation_lng=DOUBLE,
        geolocation_city=TEXT,
        geolocation_state=TEXT,
    ),
    key=("geolocation_lat", "geolocation_lng"),
)

CUSTOMERS = TableSpec(
    "customers",
    dict(
        customer_id=TEXT,
        customer_unique_id=TEXT,
        customer_zip_code_prefix=TEXT,
        customer_city=TEXT,
        customer_state=TEXT,
    ),
    key=("customer_id",),
)

SELLERS = TableSpec(
    "sellers",
    dict(seller_id=TEXT, seller_zip_code_prefix=TEXT, seller_city=TEXT, seller_state=TEXT),
    key=("seller_id",),
)

CATEGORY_TRANSLATION = TableSpec(
    "product_category_name_translation",
    dict(product_category_name=TEXT, product_category_name_english=TEXT),
    key=("product_category_name",),
)

PRODUCTS = TableSpec(
    "products",
    dict(
        product_id=TEXT,
        product_category_name=TEXT,
        product_name_length=INT,
        product_description_length=INT,
        product_photos_qty=INT,
        product_weight_g=INT,
        product_length_cm=INT,
        product_height_cm=INT,
        product_width_cm=INT,
    ),
    key=("product_id",),
    nullable=frozenset(("product_category_name", *_PRODUCT_MEASURES)),
    references=(
        Reference(
            ("product_category_name",),
            "product_category_name_translation",
            ("product_category_name",),
        ),
    ),
    lenient=frozenset(_PRODUCT_MEASURES),
)

ORDERS = TableSpec(
    "orders",
    dict(
        order_id=TEXT,
        customer_id=TEXT,
        order_status=TEXT,
        order_purchase_timestamp=TIME,
        order_approved_at=TIME,
        order_delivered_carrier_date=TIME,
        order_delivered_customer_date=TIME,
        order_estimated_delivery_date=TIME,
    ),
    key=("order_id",),
    nullable=frozenset(
        (
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        )
    ),
    references=(Reference(("customer_id",), "customers", ("customer_id",)),),
)

ORDER_ITEMS = TableSpec(
    "order_items",
    dict(
        order_id=TEXT,
        order_item_id=INT,
        product_id=TEXT,
        seller_id=TEXT,
        shipping_limit_date=TIME,
        price=DOUBLE,
        freight_value=DOUBLE,
    ),
    key=("order_id", "order_item_id"),
    references=(
        Reference(("order_id",), "orders", ("order_id",)),
        Reference(("product_id",), "products", ("product_id",)),
        Reference(("seller_id",), "sellers", ("seller_id",)),
    ),
)

ORDER_PAYMENTS = TableSpec(
    "order_payments",
    dict(
        order_id=TEXT,
        payment_sequential=INT,
        payment_type=TEXT,
        payment_installments=INT,
        payment_value=DOUBLE,
    ),
    key=("order_id", "payment_sequential"),
    references=(Reference(("order_id",), "orders", ("order_id",)),),
)

ORDER_REVIEWS = TableSpec(
    "order_reviews",
    dict(
        review_id=TEXT,
        order_id=TEXT,
        review_score=INT,
        review_comment_title=TEXT,
        review_comment_message=TEXT,
        review_creation_date=TIME,
        review_answer_timestamp=TIME,
    ),
    key=("review_id",),
    nullable=frozenset(
        ("review_comment_title", "review_comment_message", "review_answer_timestamp")
    ),
    references=(Reference(("order_id",), "orders", ("order_id",)),),
    free_text=("review_comment_title", "review_comment_message"),
)

DIM_CUSTOMER = TableSpec(
    "dim_customer",
    dict(
        customer_key=INT,
        customer_id=TEXT,
        customer_unique_id=TEXT,
        customer_zip_code_prefix=TEXT,
        customer_city=TEXT,
        customer_state=TEXT,
    ),
    key=("customer_key",),
    limits=dict(
        customer_id=64,
        customer_unique_id=64,
        customer_zip_code_prefix=16,
        customer_city=128,
        customer_state=8,
    ),
)

DIM_SELLER = TableSpec(
    "dim_seller",
    dict(
        seller_key=INT,
        seller_id=TEXT,
        seller_zip_code_prefix=TEXT,
        seller_city=TEXT,
        seller_state=TEXT,
    ),
    key=("seller_key",),
    limits=dict(seller_id=64, seller_zip_code_prefix=16, seller_city=128, seller_state=8),
)

DIM_GEOLOCATION = TableSpec(
    "dim_geolocation",
    dict(
        geolocation_key=INT,
        geolocation_zip_code_prefix=TEXT,
        geolocation_city=TEXT,
        geolocation_state=TEXT,
        geolocation_lat=DOUBLE,
        geolocation_lng=DOUBLE,
    ),
    key=("geolocation_key",),
    nullable=frozenset(("geolocation_lat", "geolocation_lng")),
    limits=dict(geolocation_zip_code_prefix=16, geolocation_city=128, geolocation_state=8),
)

DIM_PRODUCT = TableSpec(
    "dim_product",
    dict(
        product_key=INT,
        product_id=TEXT,
        product_english_category_name=TEXT,
        product_category_name=TEXT,
        product_weight_g=INT,
        product_length_cm=INT,
        product_height_cm=INT,
        product_width_cm=INT,
        product_volume_cm3=INT,
        product_density_g_per_cm3=DOUBLE,
    ),
    key=("product_key",),
    nullable=frozenset(
        (
            "product_english_category_name",
            "product_category_name",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
            "product_volume_cm3",
            "product_density_g_per_cm3",
        )
    ),
    limits=dict(product_id=64, product_english_category_name=256, product_category_name=256),
)

DIM_ORDER_STATUS = TableSpec(
    "dim_order_status",
    dict(order_status_key=INT, order_status=TEXT),
    key=("order_status_key",),
    limits=dict(order_status=64),
)

DIM_PAYMENT_TYPE = TableSpec(
    "dim_payment_type",
    dict(payment_type_key=INT, payment_type=TEXT),
    key=("payment_type_key",),
    limits=dict(payment_type=64),
)

DIM_TIME = TableSpec(
    "dim_time",
    dict(
        date_id=INT,
        full_date=DATE,
        year=INT,
        quarter=INT,
        month=INT,
        day=INT,
        day_of_week=INT,
        day_name=TEXT,
        week_of_year_iso=INT,
        is_weekend=FLAG,
    ),
    key=("date_id",),
    limits=dict(day_name=16),
)

FACT_ORDER_ITEM = TableSpec(
    "fact_order_item",
    dict(
        order_item_fact_key=LONG,
        order_id=TEXT,
        order_item_id=INT,
        product_key=INT,
        customer_key=INT,
        seller_key=INT,
        order_status_key=INT,
        item_price=MONEY,
        freight_value=MONEY,
    ),
    key=("order_item_fact_key",),
    references=(
        Reference(("product_key",), "dim_product", ("product_key",)),
        Reference(("customer_key",), "dim_customer", ("customer_key",)),
        Reference(("seller_key",), "dim_seller", ("seller_key",)),
        Reference(("order_status_key",), "dim_order_status", ("order_status_key",)),
    ),
    limits=dict(order_id=64),
)

# --- end of fixed values ----------------------------------------------------------------------


def _by_name(*specs: TableSpec) -> dict[str, TableSpec]:
    return {s.name: s for s in specs}


SOURCE_TABLES = _by_name(
    GEOLOCATIONS,
    CATEGORY_TRANSLATION,
    CUSTOMERS,
    SELLERS,
    PRODUCTS,
    ORDERS,
    ORDER_ITEMS,
    ORDER_PAYMENTS,
    ORDER_REVIEWS,
)

STAR_TABLES = _by_name(
    DIM_CUSTOMER,
    DIM_SELLER,
    DIM_GEOLOCATION,
    DIM_PRODUCT,
    DIM_ORDER_STATUS,
    DIM_PAYMENT_TYPE,
    DIM_TIME,
    FACT_ORDER_ITEM,
)
