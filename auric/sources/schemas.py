"""Raw source schemas and the columns each cleaning step requires.

Bronze keeps values as text (JSON numbers read into a string field keep their
literal text), which skips an inference pass over the files and keeps the
leading zeros of postcodes and barcodes. CSV columns are taken by the file's
own header. An order document is kept whole as text, beside the fields that
the cleaning reads.
"""

from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


CUSTOMER_COLUMNS = (
    "customer_id", "tax_id", "tax_code", "customer_name", "state", "city", "postcode",
    "street", "number", "unit", "region", "district", "lat", "lon", "ship_to_address",
    "valid_from", "valid_to", "units_purchased", "loyalty_segment",
)
PRODUCT_COLUMNS = ("product_id", "product_category", "product_name", "sales_price",
                   "EAN13", "EAN5", "product_unit")
LOYALTY_COLUMNS = ("loyalty_segment_id", "loyalty_segment_description", "unit_threshold",
                   "valid_from", "valid_to")

CUSTOMERS_CSV = _strings(*CUSTOMER_COLUMNS)
PRODUCTS_CSV = _strings(*PRODUCT_COLUMNS)
LOYALTY_CSV = _strings(*LOYALTY_COLUMNS)

LINE_FIELDS = ("id", "name", "price", "qty", "curr")
ORDERED_PRODUCT = _strings(*LINE_FIELDS)
# The whole order document as text, and the same where it is no valid JSON.
RAW, CORRUPT = "raw_document", "corrupt_document"
# A CSV line that does not fit its file's header.
CORRUPT_ROW = "corrupt_row"

SALES_ORDERS_JSON = StructType([
    StructField("order_number", StringType(), True),
    StructField("customer_id", StringType(), True),
    StructField("customer_name", StringType(), True),
    StructField("order_datetime", StringType(), True),
    StructField("number_of_line_items", StringType(), True),
    StructField("ordered_products", ArrayType(ORDERED_PRODUCT), True),
])

AUDIT_COLUMNS = ("_ingest_ts", "_source_file", "_batch_id")

# Columns each silver step reads; checked before transforming so schema drift
# fails with a message naming what is missing.
REQUIRED = {
    "customers": ("customer_id", "customer_name", "state", "city", "valid_from"),
    "products": PRODUCT_COLUMNS,
    "loyalty_segments": LOYALTY_COLUMNS,
    "sales_orders": ("order_number", "customer_id", "customer_name", "order_datetime",
                     "number_of_line_items", "ordered_products"),
}
