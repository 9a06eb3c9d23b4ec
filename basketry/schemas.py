"""Target schema of the sales fact and of the tables derived from it."""

from pyspark.sql import types as T

# Column names and order of the sales fact.
SALES_COLUMNS = [
    "invoice", "storeInvoice", "orderDate", "time", "productId", "productName", "barcode",
    "quantity", "sellingPrice", "discountAmount", "totalProductPrice", "deliveryFee",
    "HSNCode", "GST", "GSTAmount", "CGSTRate", "CGSTAmount", "SGSTRate", "SGSTAmount",
    "acessAmount", "cess", "cessAmount", "orderAmountTax", "orderAmountNet", "cashAmount",
    "cardAmount", "upiAmount", "creditAmount", "costPrice", "description", "brandName",
    "categoryName", "subCategoryOf", "storeName", "GSTIN", "orderType", "paymentMethod",
    "customerName", "customerNumber", "orderFrom", "orderStatus",
]
INTEGER_COLUMNS = ["productId", "quantity"]
BIGINT_COLUMNS = ["barcode"]
NUMERIC_COLUMNS = ["GST", "CGSTRate", "SGSTRate", "acessAmount", "cess"]
MONEY_COLUMNS = [
    "sellingPrice", "discountAmount", "totalProductPrice", "deliveryFee", "GSTAmount",
    "CGSTAmount", "SGSTAmount", "cessAmount", "orderAmountTax", "orderAmountNet",
    "cashAmount", "cardAmount", "upiAmount", "creditAmount", "costPrice",
]
REQUIRED_SALES_COLUMNS = [
    "invoice", "orderDate", "productId", "productName", "quantity",
    "totalProductPrice", "brandName", "subCategoryOf", "storeName", "orderType",
]
REQUIRED_AGGREGATE_COLUMNS = [
    "invoice", "orderDate", "brandName", "storeName",
    "subCategoryOf", "productName", "totalProductPrice", "quantity",
]
STOCK_COLUMNS = [
    "productName", "brand", "categoryName", "vendorName", "quantity", "sellingPrice",
    "costPrice", "printedMrp", "totalAmount",
]
STOCK_NUMERIC_COLUMNS = ["quantity", "sellingPrice", "costPrice", "printedMrp", "totalAmount"]
RTV_COLUMNS = [
    "rtvId", "Date", "time", "vendorName", "productId", "productName", "barcode", "quantity",
    "price", "totalAmount", "description", "storeName", "doneBy",
]
RTV_NUMERIC_COLUMNS = ["quantity", "price", "totalAmount"]
# End of fixed values.

MONEY = T.DecimalType(18, 4)


def sales_type(column: str) -> T.DataType:
    """Spark type of one column of the sales fact."""
    if column == "orderDate":
        return T.DateType()
    if column in INTEGER_COLUMNS:
        return T.IntegerType()
    if column in BIGINT_COLUMNS:
        return T.LongType()
    if column in NUMERIC_COLUMNS:
        return T.DoubleType()
    if column in MONEY_COLUMNS:
        return MONEY
    return T.StringType()


SALES_SCHEMA = T.StructType([T.StructField(c, sales_type(c)) for c in SALES_COLUMNS])


def all_strings(columns) -> T.StructType:
    """Schema that reads every column as text; typing happens in the transform step."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
