"""Operator inputs derived from the test tables, one Spark frame and one SQL text each.

Column expressions are plain SQL understood by both engines and shared as text.
Every input is row-local (or a key join), so it grows with the tables.
Remainders of keys only decide which rows carry which kind of damage.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.conform import stack
from ledgerloom.sources import json


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors reach; a local session without one gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_files(lines: DataFrame, name: str) -> str:
    """Text files below a new folder, one folder and file for each ``file`` of the lines (``file, pos, line``); files may share a name."""
    path = folder(lines.sparkSession, name)
    ordered = lines.repartition("file").sortWithinPartitions("file", "pos")
    ordered.select("file", "line").write.partitionBy("file").text(path)
    return path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*(F.expr(text).alias(name) for name, text in columns.items()))


def _sql(columns: dict[str, str], source: str, where: str = "") -> str:
    shown = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return f"SELECT {shown} FROM {source} {where}"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"])


ORDERS_SQL = "orders JOIN customer ON o_custkey = c_custkey"

CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
COMPANY = "'C' || CAST(c_custkey AS STRING)"
CURRENCY = (
    "CASE c_nationkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'inr' "
    "WHEN 3 THEN 'JPY' END"
)

# Ledger lines: one per order, everything still text, with damaged values among them.
LEDGER = {
    "line_id": "o_orderkey",
    "company_id": (
        f"CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '  ' "
        f"ELSE {COMPANY} END"
    ),
    "company_name": "CASE WHEN c_nationkey = 7 THEN NULL ELSE c_name END",
    "period": (
        "CASE WHEN o_orderkey % 59 = 0 THEN NULL "
        "WHEN year(o_orderdate) = 1998 AND o_orderkey % 3 = 0 THEN 'CY' "
        "WHEN year(o_orderdate) = 1998 AND o_orderkey % 3 = 1 THEN 'Current Year' "
        "WHEN year(o_orderdate) = 1998 THEN 'current' "
        "WHEN year(o_orderdate) = 1997 AND o_orderkey % 2 = 0 THEN 'py' "
        "WHEN year(o_orderdate) = 1997 THEN 'Previous Year' "
        "ELSE 'fy' || CAST(year(o_orderdate) AS STRING) END"
    ),
    "year": (
        "CASE WHEN o_orderkey % 83 = 0 THEN '20x' || CAST(o_orderkey % 10 AS STRING) "
        "WHEN o_orderkey % 79 = 0 THEN NULL WHEN o_orderkey % 73 = 0 THEN ' ' "
        "WHEN o_orderkey % 71 = 0 THEN ' ' || CAST(year(o_orderdate) AS STRING) "
        "ELSE CAST(year(o_orderdate) AS STRING) END"
    ),
    "revenue": f"CASE WHEN o_orderkey % 67 = 0 THEN 'n/a' ELSE CAST({CENTS} AS STRING) END",
    "profit": (
        f"CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 53 = 0 THEN '-5' "
        f"WHEN o_orderkey % 47 = 0 THEN '12.75' "
        f"ELSE CAST({CENTS} % 1000 AS STRING) || ',extra' END"
    ),
    "currency": CURRENCY,
    "source_file": "'ledger_' || substr(o_orderpriority, 1, 1) || '.csv'",
    "order_status": "o_orderstatus",
}
LEDGER_SQL = _sql(LEDGER, ORDERS_SQL)


def ledger(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ledger, or the named columns of it; only what those need is read from the files."""
    wanted = {name: LEDGER[name] for name in columns or LEDGER}
    return _select(_orders(spark, sf_dir), wanted)


# One XML element per order: current and previous figures, some incomplete.
PERIOD_ELEMENT = (
    f"'<entity><identifier> ' || {COMPANY} || ' </identifier>' || "
    f"CASE WHEN o_orderkey % 43 = 0 THEN '' ELSE "
    f"CASE WHEN o_orderstatus = 'P' THEN '<financials>' ELSE '<financials period=\"CY\">' END || "
    f"'<revenue>' || CAST({CENTS} AS STRING) || '</revenue>' || "
    f"CASE WHEN o_orderkey % 41 = 0 THEN '<profit/>' "
    f"WHEN o_orderkey % 37 = 0 THEN '' "
    f"ELSE '<profit>' || CAST({CENTS} % 1000 AS STRING) || '</profit>' END || '</financials>' || "
    f"'<financials period=\"PY\"><revenue>' || CAST({CENTS} % 100000 AS STRING) || "
    f"'</revenue></financials>' END || '</entity>'"
)
XML_FILE = "'filing_' || substr(o_orderpriority, 1, 1) || '.xml'"


def period_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_orders(spark, sf_dir), {"element": PERIOD_ELEMENT, "source_file": XML_FILE})


def period_documents(spark: SparkSession, sf_dir: str, prefix: str | None = None) -> DataFrame:
    """The period elements as documents, cut at the closing tags; with ``prefix``, in its namespace."""
    orders = _orders(spark, sf_dir)
    body = _select(orders, {"chunk": f"replace({PERIOD_ELEMENT}, '</entity>', '')", "source_file": XML_FILE})
    root = f'<?xml version="1.0" encoding="UTF-8"?><!-- entity --><xbrl xmlns{":" + prefix if prefix else ""}="urn:x">'
    files = _select(orders, {"source_file": XML_FILE}).distinct()
    ends = files.select(F.explode(F.array(F.lit(root), F.lit("</xbrl>"))).alias("chunk"), "source_file")
    if prefix:
        body = body.withColumn("chunk", F.regexp_replace("chunk", r"<(/?)(entity|identifier|financials|revenue|profit)", f"<$1{prefix}:$2"))
        ends = ends.withColumn("chunk", F.regexp_replace("chunk", r"<(/?)xbrl", f"<$1{prefix}:xbrl"))
    return stack([body, ends])


def period_files(spark: SparkSession, sf_dir: str, prefix: str | None = None) -> str:
    """The period elements as files on disk, one document for each source file."""
    body = _select(_orders(spark, sf_dir), {"file": XML_FILE, "pos": "o_orderkey", "line": PERIOD_ELEMENT})
    if prefix:
        body = body.withColumn("line", F.regexp_replace("line", r"<(/?)(entity|identifier|financials|revenue|profit)", f"<$1{prefix}:$2"))
    root = f"{prefix}:xbrl" if prefix else "xbrl"
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<!-- <entity> --><{root} xmlns{":" + prefix if prefix else ""}="urn:x">'
    ends = F.array(*(F.struct(F.lit(at).alias("pos"), F.lit(text).alias("line")) for at, text in ((-1, head), (1 << 60, f"</{root}>"))))
    files = body.select("file").distinct().select("file", F.inline(ends))
    return write_files(body.unionByName(files), "xml")


# One Company element per order; customers without balance lack the details.
COMPANY_ELEMENT = (
    f"'<Company><CompanyID>' || {COMPANY} || '</CompanyID>' || "
    f"CASE WHEN c_acctbal < 0 THEN '' ELSE '<Details><Name>' || c_name || '</Name>' || "
    f"CASE WHEN o_orderstatus = 'P' THEN '' ELSE '<Financials><Revenue>' || CAST({CENTS} AS STRING) "
    f"|| '</Revenue><Year>' || CAST(year(o_orderdate) AS STRING) || '</Year></Financials>' END "
    f"|| '</Details>' END || '</Company>'"
)


def company_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_orders(spark, sf_dir), {"element": COMPANY_ELEMENT, "source_file": XML_FILE})


# One JSON record per order: zero revenue, missing and null objects included.
NESTED_RECORD = (
    f"'{{\"company\":' || CASE WHEN o_orderkey % 31 = 0 THEN 'null' ELSE "
    f"'{{\"company_id\":\"' || {COMPANY} || '\"' || "
    f"CASE WHEN o_orderkey % 29 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN ',\"details\":null' ELSE "
    f"',\"details\":{{\"year\":' || CAST(year(o_orderdate) AS STRING) || ',\"financials\":{{\"revenue\":' || "
    f"CASE WHEN o_orderkey % 19 = 0 THEN '0' WHEN o_orderkey % 17 = 0 THEN '\"0\"' "
    f"ELSE CAST({CENTS} AS STRING) END || ',\"currency\":\"' || coalesce({CURRENCY}, '') || '\"}}}}' END "
    f"|| '}}' END || '}}'"
)
JSON_FILE = "'report_' || substr(o_orderpriority, 1, 1) || '.json'"


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _select(_orders(spark, sf_dir), {"record": NESTED_RECORD, "source_file": JSON_FILE})
    return json.parse_records(texts, ["company"])


PERIOD_RECORD = (
    f"'{{\"company_id\":\"' || {COMPANY} || '\",\"financials\":' || "
    f"CASE WHEN o_orderkey % 31 = 0 THEN 'null' ELSE "
    f"'{{\"CY\":' || CASE WHEN o_orderkey % 29 = 0 THEN 'null' ELSE '{{\"revenue\":' || CAST({CENTS} AS STRING) || '}}' END "
    f"|| CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN ',\"PY\":null' "
    f"ELSE ',\"PY\":{{\"revenue\":' || CAST({CENTS} % 100000 AS STRING) || '}}' END || '}}' END || '}}'"
)


def period_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _select(_orders(spark, sf_dir), {"record": PERIOD_RECORD, "source_file": JSON_FILE})
    return json.parse_records(texts, ["company_id", "financials"])


# What stands before some of the records of a list, without being a record.
OTHER_ELEMENTS = (
    "CASE WHEN o_orderkey % 13 = 0 THEN '5,' WHEN o_orderkey % 11 = 0 THEN 'null, \"x}{\",' "
    "WHEN o_orderkey % 7 = 0 THEN '[{\"a\":1},2],' ELSE '' END"
)


def json_pieces(spark: SparkSession, sf_dir: str, others: str = "''") -> DataFrame:
    """The nested records, ``others`` before them, from within one list per file, cut at
    closing braces into small blocks."""
    records = _select(_orders(spark, sf_dir), {
        "file": JSON_FILE, "line_id": "o_orderkey", "parts": f"split(',' || {others} || {NESTED_RECORD}, '}}', -1)",
    })
    pieces = records.select(
        "file", "line_id",
        # Without the empty text after the last brace: the next record goes on there.
        F.posexplode(F.slice("parts", F.lit(1), F.size("parts") - 1)).alias("n", "line"),
    )
    return pieces.select(
        "file", F.expr("line_id div 300").alias("block"),
        F.expr("line_id * 100 + n").alias("pos"), "line",
    )


# Whole files of every shape, by the first letter of the priority: lists, lines and one object.
# A list starts with an empty record, the object is one list of records.
FILE_SHAPE = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'list' WHEN '2' THEN 'lines' WHEN '3' THEN 'lines' "
    "WHEN '4' THEN 'list' ELSE 'object' END"
)
LINE_ELEMENTS = (
    "CASE WHEN o_orderkey % 13 = 0 THEN '5\n' WHEN o_orderkey % 11 = 0 THEN 'null\n\n\"x}{\"\n' "
    "WHEN o_orderkey % 7 = 0 THEN ' [{\"a\":1},2]\n' ELSE '' END"
)


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested records, other elements among them, as whole files cut at closing braces into small blocks."""
    orders = _orders(spark, sf_dir)
    body = f"CASE WHEN {FILE_SHAPE} = 'lines' THEN '\n' || {LINE_ELEMENTS} ELSE ',' || {OTHER_ELEMENTS} END || {NESTED_RECORD}"
    records = _select(orders, {"file": JSON_FILE, "line_id": "o_orderkey", "parts": f"split({body}, '}}', -1)"})
    pieces = records.select("file", "line_id", F.posexplode(F.slice("parts", F.lit(1), F.size("parts") - 1)).alias("n", "line"))
    inner = pieces.select("file", F.expr("line_id div 300").alias("block"), F.expr("line_id * 100 + n").alias("pos"), "line")
    files = _select(orders, {"file": JSON_FILE, "shape": FILE_SHAPE}).distinct()
    ends = files.selectExpr(
        "file", "CAST(-1 AS BIGINT) AS block", "CAST(-1 AS BIGINT) AS pos",
        "CASE shape WHEN 'list' THEN ' [{' WHEN 'object' THEN '{\"all\":[{' END AS line",
    ).union(files.selectExpr(
        "file", "CAST(1000000000000 AS BIGINT)", "CAST(1000000000000 AS BIGINT)",
        "CASE shape WHEN 'list' THEN ']' WHEN 'object' THEN ']' ELSE '\n' END"))
    return inner.unionByName(ends.where("line IS NOT NULL"))


# CSV lines: one file per nation, one table per customer, one data line per order.
# A line's place is the customer and day; a block ends within a customer's table.
DAY = "datediff(CAST(o_orderdate AS DATE), DATE '1995-01-01')"
WIDE, NARROW = ",company_id,profit,year,remarks", "Year ,REMARKS,Company_ID,profit,"
_PROFIT = f"'\"' || CAST({CENTS} % 1000 AS STRING) || ',extra\"'"
_REMARK = "'text_' || CAST(o_orderkey AS STRING) || '|extra'"
_YEAR = "CASE WHEN o_orderkey % 83 = 0 THEN '20x3' ELSE CAST(year(o_orderdate) AS STRING) END"
DATA_LINE = (
    f"CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') "
    f"THEN ',' || {COMPANY} || ',' || {_PROFIT} || ',' || {_YEAR} || ',' || {_REMARK} "
    f"ELSE ' ' || {_YEAR} || ' ,' || {_REMARK} || ',' || {COMPANY} || ',' || {_PROFIT} END"
)
HEADER_LINE = f"CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN '{WIDE}' ELSE '{NARROW}' END"
PLACES_PER_CUSTOMER, PLACES_PER_BLOCK = 10_000, 170_003
MIDDLE_DAY = 1096  # 1998-01-01


# Lines around the data of a customer: segment it is limited to, place, text.
FRAME_LINES = (
    ("FURNITURE", 0, f"'{WIDE}'"),                   # replaced at once by the next header
    (None, 1, HEADER_LINE),
    (None, 2, "',,,'"),                              # blank before any data: table stays open
    ("BUILDING", 2 * MIDDLE_DAY + 4, "''"),          # ends the table, if it has data by then
    ("MACHINERY", 2 * MIDDLE_DAY + 4, "',Entity Name , ' || c_name || ',,'"),
    ("MACHINERY", 2 * MIDDLE_DAY + 4, "',,period start date,,'"),  # no value: dropped
    (None, 9000, "' , ,'"),
    (None, 9001, "'stray,words'"),                   # between tables: dropped
)


def csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    def line(place: str, text: str) -> str:
        file = "'tables/nation_' || CAST(c_nationkey AS STRING) || '.csv'"
        pos = f"CAST(c_custkey * {PLACES_PER_CUSTOMER} + {place} AS BIGINT)"
        return f"named_struct('file', {file}, 'pos', {pos}, 'line', {text})"

    framed = ", ".join(
        line(place, text) if segment is None
        else f"CASE WHEN c_mktsegment = '{segment}' THEN {line(place, text)} END"
        for segment, place, text in FRAME_LINES
    )
    frame = table(spark, sf_dir, "customer").selectExpr(f"inline(array_compact(array({framed})))")
    data = line(f"2 * {DAY} + 5", DATA_LINE)
    lines = frame.unionByName(_orders(spark, sf_dir).selectExpr(f"inline(array({data}))"))
    return lines.withColumn("block", F.expr(f"pos div {PLACES_PER_BLOCK}"))


# Lines of files whose cells may go over several lines: a remark of one to three lines, some with quotes, commas and blank lines in it.
LONG_REMARK = (
    "CASE o_orderkey % 5 WHEN 0 THEN 'plain' WHEN 1 THEN '\"two' || chr(13) || chr(10) || ' lines\"' "
    "WHEN 2 THEN '\"a, \"\"b\"\"' || chr(10) || chr(10) || 'company_id,year' || chr(10) || 'end\"' WHEN 3 THEN '\"' || chr(10) || '\"' ELSE 'say \"x' END"
)


def multiline_files(spark: SparkSession, sf_dir: str) -> str:
    """One file per nation: a header, then one record per order."""
    record = f"{COMPANY} || ',' || {_YEAR} || ',' || {LONG_REMARK} || ',' || CAST({CENTS} % 1000 AS STRING)"
    body = _select(_orders(spark, sf_dir), {"file": "'nation_' || CAST(c_nationkey AS STRING)", "pos": "o_orderkey", "line": record})
    head = body.select("file").distinct().select("file", F.lit(-1).cast("long").alias("pos"), F.lit("Company_ID,Year,Remarks,Profit").alias("line"))
    return write_files(body.unionByName(head), "csv")


# Stored dimension and an incoming batch of companies.
STORED_VERSION = {
    "dim_company_sk": "c_custkey + 1",
    "company_id": COMPANY,
    "company_name": "CASE WHEN c_nationkey = 7 THEN NULL ELSE upper(c_name) END",
    "valid_from": (
        "CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '1998-06-01 00:00:00' "
        "ELSE TIMESTAMP '1996-01-01 00:00:00' END"
    ),
    "valid_to": "TIMESTAMP '9999-12-31 00:00:00'",
    "is_current": "TRUE",
    "created_at": "TIMESTAMP '1996-01-01 00:00:00'",
    "updated_at": "TIMESTAMP '1996-01-01 00:00:00'",
}
CLOSED_VERSION = {
    **STORED_VERSION,
    "dim_company_sk": "c_custkey + 1000000000",
    "company_name": "'FORMER ' || upper(c_name)",
    "valid_from": "TIMESTAMP '1996-01-01 00:00:00'",
    "valid_to": "TIMESTAMP '1998-06-01 00:00:00'",
    "is_current": "FALSE",
}
STORED, REPLACED = "c_mktsegment <> 'AUTOMOBILE'", "c_mktsegment = 'BUILDING'"
DIMENSION_SQL = (
    f"{_sql(STORED_VERSION, 'customer', f'WHERE {STORED}')} UNION ALL "
    f"{_sql(CLOSED_VERSION, 'customer', f'WHERE {REPLACED}')}"
)


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    stored = _select(customer.where(STORED), STORED_VERSION)
    closed = _select(customer.where(REPLACED), CLOSED_VERSION)
    return stack([stored, closed])


INCOMING_CUSTOMER = {
    "company_id": f"CASE WHEN c_nationkey = 24 THEN NULL ELSE {COMPANY} END",
    "company_name": (
        "CASE WHEN c_nationkey = 11 THEN NULL WHEN c_acctbal < 0 THEN upper(c_name) || ' LTD' "
        "ELSE upper(c_name) END"
    ),
}
INCOMING_SUPPLIER = {
    "company_id": "'S' || CAST(s_suppkey AS STRING)",
    "company_name": "CASE WHEN s_nationkey = 11 THEN NULL ELSE upper(s_name) END",
}
PRESENT = "c_nationkey <> 3"
INCOMING_SQL = (
    f"{_sql(INCOMING_CUSTOMER, 'customer', f'WHERE {PRESENT}')} UNION ALL "
    f"{_sql(INCOMING_SUPPLIER, 'supplier')}"
)


def incoming_frames(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [
        _select(table(spark, sf_dir, "customer").where(PRESENT), INCOMING_CUSTOMER),
        _select(table(spark, sf_dir, "supplier"), INCOMING_SUPPLIER),
    ]


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, incoming_frames(spark, sf_dir))
