"""Raw retail inputs derived from the provided tables.

Each text below runs unchanged on Spark and on DuckDB, so both sides start from
the same dirty rows. Names in braces are tables. Numbers of sales, counts, items
and recipe links all follow from the tables; amounts are multiples of 1/8, so that
sums do not depend on the order of addition.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.settle import apart

# Sales: one per line item. How dirty each field is follows from its keys.
SALES = """
with base as (
  select *,
    (l_partkey + l_linenumber) % 41 as f_id,
    (l_partkey * 7 + l_linenumber) % 31 as f_date,
    (l_orderkey + l_suppkey * 3 + l_linenumber * 5) % 37 as f_qty,
    (l_orderkey * 5 + l_partkey) % 29 as f_info,
    (l_orderkey + l_partkey) % 43 as f_menu,
    (l_orderkey * 3 + l_suppkey) % 23 as f_emp,
    cast(cast(l_quantity as bigint) % 9 + 1 as string) as n,
    cast(year(l_shipdate) as string) as yy,
    lpad(cast(month(l_shipdate) as string), 2, '0') as mm,
    lpad(cast(day(l_shipdate) as string), 2, '0') as dd,
    substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(month(l_shipdate) * 3 - 2 as int), 3) as mon,
    lpad(cast(l_suppkey % 24 as string), 2, '0') as hh,
    lpad(cast(case when l_suppkey % 12 = 0 then 12 else l_suppkey % 12 end as string), 2, '0') as h12,
    case when l_suppkey % 24 < 12 then 'AM' else 'PM' end as half,
    lpad(cast(l_orderkey % 60 as string), 2, '0') as mi,
    lpad(cast(l_partkey % 60 as string), 2, '0') as ss,
    'TRX-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id
  from {lineitem}
)
select
  case f_id when 3 then null when 7 then 'NULL' when 11 then ' ' || id when 19 then 'N/A' else id end
    as Transaction_ID,
  case f_date
    when 0 then dd || '/' || mm || '/' || yy || ' ' || hh || ':' || mi
    when 1 then mon || ' ' || dd || ' ' || yy
    when 2 then yy || mm || dd || hh || mi
    when 3 then mm || '-' || dd || '-' || yy || ' ' || h12 || ':' || mi || ' ' || half
    when 4 then yy || mm || dd
    when 5 then yy || '/' || mm || '/' || dd || ' ' || hh || ':' || mi
    when 6 then dd || '-' || mon || '-' || yy || ' ' || hh || ':' || mi || ':' || ss
    when 7 then dd || '.' || mm || '.' || yy
    when 8 then yy || '-' || mm || '-' || dd || 'T' || hh || ':' || mi || ':' || ss || '+07:00'
    when 9 then 'not-a-date-???'
    when 10 then yy || '-02-30 10:00:00'
    when 11 then hh || ':' || mi || ':' || ss
    when 12 then yy || mm || dd || hh
    when 13 then 'NaN'
    when 14 then '   '
    when 15 then mm || '/' || dd || '/' || yy || ' ' || h12 || ':' || mi || ' ' || half
    when 16 then chr(9) || yy || '-' || mm || '-' || dd || ' ' || hh || ':' || mi || ':' || ss || chr(10)
    when 17 then '3000-' || mm || '-' || dd
    else yy || '-' || mm || '-' || dd || ' ' || hh || ':' || mi || ':' || ss
  end as DateTime,
  case f_emp when 0 then null when 1 then 'EMP-99' when 2 then '' when 3 then ' EMP-01 '
    else 'EMP-' || lpad(cast(l_suppkey % 8 + 1 as string), 2, '0') end as Employee_ID,
  case f_menu when 0 then null when 1 then 'none' when 2 then '  '
    when 3 then ' MENU-' || lpad(cast(l_partkey % 28 + 1 as string), 3, '0') || ' '
    else 'MENU-' || lpad(cast(l_partkey % 28 + 1 as string), 3, '0') end as Menu_ID,
  'Menu ' || cast(l_partkey % 28 + 1 as string) as Item_Name,
  case f_qty
    when 0 then n || ',5' when 1 then n || ' pcs' when 2 then '-' || n when 3 then '0'
    when 4 then null when 5 then '???' when 6 then ' ' || n || chr(9) when 7 then n || 'E0'
    when 8 then '-5 pcs' when 9 then 'nil' when 10 then 'INF' when 11 then '-Infinity'
    when 12 then '.5' when 13 then '5d' when 14 then '1,25.5' when 15 then 'nol'
    when 16 then case n when '1' then 'satu' when '2' then 'two' when '3' then 'Tiga'
      when '4' then 'four' when '5' then 'lima' when '6' then 'SIX' when '7' then 'tujuh'
      when '8' then 'eight' when '9' then ' sembilan ' else 'ten' end
    when 17 then 'None' when 18 then '-' when 19 then '1_0' when 20 then '0 cups'
    else n end as Quantity,
  case f_info when 0 then 'ERROR' when 1 then 'Err0r' when 2 then 'ROER, x' when 3 then 'TIMEOUT'
    when 4 then 'SYSERR' when 5 then ' #REF! ' when 6 then 'N/A' when 7 then 'undefined value'
    when 8 then '' when 9 then 'Inv4lid' else null end as Additional_Info,
  l_shipdate, l_partkey, l_suppkey, l_orderkey, l_linenumber, l_returnflag
from base
"""

# What orders sales that share an id: unique over the table.
SALE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")

# Counts: one record per order date and urgency, one entry per customer group.
STOCK_ENTRIES = """
with grouped as (
  select o_orderdate,
    case when o_orderpriority = '1-URGENT' then 1 else 0 end as copy,
    cast(o_custkey % 46 + 1 as int) as item,
    sum(cast(round(o_totalprice * 100) as bigint)) as cents, count(*) as n
  from {orders} group by 1, 2, 3
), numbered as (
  select *, cast(year(o_orderdate) * 372 + month(o_orderdate) * 31 + day(o_orderdate) as bigint) as d
  from grouped
), flagged as (
  select *, (d * 7 + item * 3 + n) % 67 as f_count, (d + item) % 53 as f_delivery,
    (d * 3 + copy) % 59 as f_date, (d + item * 5) % 61 as f_item,
    case when year(o_orderdate) % 2 = 0 then 'old' else 'new' end as key_name
  from numbered
)
select
  'WH-' || cast(d as string) || '-' || cast(copy as string) as record_id,
  case f_date when 0 then 'unknown' when 1 then null
    when 2 then lpad(cast(month(o_orderdate) as string), 2, '0') || '/'
      || lpad(cast(day(o_orderdate) as string), 2, '0') || '/' || cast(year(o_orderdate) as string)
    when 3 then cast(year(o_orderdate) as string) || '-' || lpad(cast(month(o_orderdate) as string), 2, '0')
      || '-' || lpad(cast(day(o_orderdate) as string), 2, '0') || 'T08:30:00'
    else cast(year(o_orderdate) as string) || '-' || lpad(cast(month(o_orderdate) as string), 2, '0')
      || '-' || lpad(cast(day(o_orderdate) as string), 2, '0') end as date_text,
  'EMP-' || lpad(cast(d % 6 + 1 as string), 2, '0') as recorded_by,
  d * 2 + copy as rec_ord,
  item as entry_pos,
  case f_item when 0 then null when 1 then '' when 2 then ' INV-' || lpad(cast(item as string), 4, '0')
    else 'INV-' || lpad(cast(item as string), 4, '0') end as item_text,
  case f_count when 5 then 'both' when 6 then 'hidden' else key_name end as key_name,
  case f_count when 0 then 'ERROR' when 1 then null when 2 then 'nan' when 3 then '-12.5'
    when 4 then 'N/A' else cast(cents % 2600 as string) || '.5' end as count_text,
  case f_delivery when 0 then 'absent' when 1 then 'null' else 'set' end as delivery_key,
  case f_delivery when 2 then 'late' else cast(cents % 300 as string) || '.25' end as delivery_text,
  case when item % 3 = 0 then ' Gram ' when item % 3 = 1 then 'ml' else 'PCS' end as uom_text
from flagged
"""

# Items: one row per part group and per half of the part sizes; the second half
# repeats the ids of the first with other levels.
INVENTORY = """
with grouped as (
  select cast(p_partkey % 44 + 1 as int) as item, cast(p_size % 2 as int) as copy,
    min(p_size) as small, count(*) as n
  from {part} group by 1, 2
)
select
  case when item = 44 and copy = 1 then null else ' INV-' || lpad(cast(item as string), 4, '0') || ' ' end
    as Item_ID,
  ' Item ' || cast(item as string) as Item_Name,
  case item % 7 when 0 then 'Kilogram' when 1 then 'Liter ' when 2 then 'Pcs' when 3 then 'Karton'
    when 4 then 'Karton' when 5 then 'Box' else 'Pcs' end as Supplier_UoM,
  case (item + copy) % 11 when 0 then '' when 1 then 'abc' when 2 then '-3' when 3 then 'N/A'
    else cast(small * 40 as string) || '.5' end as Min_Stock_Threshold,
  case when item % 2 = 0 then 'Bahan' else 'Kemasan' end as Category,
  cast(copy * 100 + item as bigint) as inv_ord
from grouped
"""

# Recipe links: one per menu and ingredient, some of them unusable.
MENU_LINKS = """
with grouped as (
  select cast(p_size % 25 + 1 as int) as menu,
    cast((p_size % 25 * 3 + p_partkey % 9) % 40 + 1 as int) as item,
    min(p_size) as small, count(*) as n
  from {part} group by 1, 2
)
select
  case when menu = 25 then ' MENU-' else 'MENU-' end || lpad(cast(menu as string), 3, '0') as Menu_ID,
  'Menu ' || cast(menu as string) as Menu_Name,
  case when menu % 6 = 0 then 'Rp 18rb' else cast(menu * 1000 as string) end as Selling_Price_IDR,
  menu as menu_no,
  item as link_pos,
  case when (menu * 5 + item) % 37 = 0 then null
    else ' INV-' || lpad(cast(item as string), 4, '0') end as item_text,
  case (menu * 7 + item) % 23 when 0 then 'bad' when 1 then null when 2 then 'infinity'
    when 3 then '-0.5' when 4 then '0'
    else cast(small % 3 as string) || '.' || substr('00255075', cast((menu + item) % 4 * 2 + 1 as int), 2)
    end as qty_text,
  case when item % 2 = 0 then ' Gram' else 'ML' end as uom_text
from grouped
"""

# Employees: one per supplier group, with an empty, a missing and a padded id.
EMPLOYEES = """
select distinct
  case s_suppkey % 8 when 5 then '' when 6 then null when 3 then 'EMP-04 '
    else 'EMP-' || lpad(cast(s_suppkey % 8 + 1 as string), 2, '0') end as Employee_ID,
  'Employee ' || cast(s_suppkey % 8 + 1 as string) as Full_Name,
  case when s_suppkey % 8 < 2 then 'Shift_Lead' else 'Barista' end as Role,
  case when s_suppkey % 2 = 0 then 'Pagi' else 'Malam' end as Shift
from {supplier}
"""


# The items that the derived recipes use, for tables with a column per item.
ITEMS = [f"INV-{n:04d}" for n in range(1, 41)]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(spark: SparkSession, sf_dir: str, text: str, table: str, *by: str) -> DataFrame:
    # Dealt out by Spark's own number, which AQE lowers by bytes, so that tasks grow in number and not in size.
    rows = _table(spark, sf_dir, table)
    return spark.sql(text, **{table: rows.repartition(*by) if by else rows})


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales, all text, with their place and the data set they belong to."""
    raw = _derive(spark, sf_dir, SALES, "lineitem", "l_orderkey", "l_partkey", "l_suppkey")
    # One field holds the fence: a whole struct below it is put together uncompiled, and a test that the
    # place is not null, which a join pushes to the scan, would do so a second time.
    *before, last = SALE_ORDER
    place = F.struct(*before, apart(F.col(last)).alias(last))
    return raw.select(
        "Transaction_ID", "DateTime", "Employee_ID", "Menu_ID", "Item_Name", "Quantity",
        "Additional_Info", place.alias("_ord"), F.col("l_returnflag").alias("dataset"),
    )


def stock_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, STOCK_ENTRIES, "orders")


def stock_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries packed into one record per date and urgency, keys drifting.

    A record has at most one entry per customer group, so its list is short.
    """
    entry = F.col

    def pair(key: str, value, when=F.lit(True)):
        return F.when(when, F.map_from_arrays(F.array(F.lit(key)), F.array(value)))

    key = entry("key_name")
    parts = F.array(
        pair("Item_ID", entry("item_text")),
        pair("stock_remaining", entry("count_text"), key.isin("old", "both")),
        pair("stock_remaining", F.lit(None).cast("string"), key == "hidden"),
        pair("sisa_stok_akhir", entry("count_text"), key.isin("new", "hidden")),
        pair("sisa_stok_akhir", F.lit("999"), key == "both"),
        pair("delivery_in", entry("delivery_text"), entry("delivery_key") == "set"),
        pair("delivery_in", F.lit(None).cast("string"), entry("delivery_key") == "null"),
        pair("UoM", entry("uom_text")),
    )
    entries = F.flatten(
        F.transform(F.filter(parts, lambda p: p.isNotNull()), lambda p: F.map_entries(p))
    )
    packed = stock_entries(spark, sf_dir).select(
        "record_id", "date_text", "recorded_by", "rec_ord",
        F.struct("entry_pos", F.map_from_entries(entries).alias("entry")).alias("_e"),
    )
    return packed.groupBy("record_id", "date_text", "recorded_by", "rec_ord").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_e.entry_pos", F.map_entries("_e.entry").alias("kv")))),
                    lambda e: F.map_from_entries(e["kv"])).alias("stock_entries")
    ).select(
        "record_id", F.col("date_text").alias("date"), "recorded_by", "stock_entries",
        F.col("rec_ord").alias("_ord"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw item list, all text."""
    return _derive(spark, sf_dir, INVENTORY, "part").withColumnRenamed("inv_ord", "_ord")


def menus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menus with their ingredient lists (at most nine links each), and one without any."""
    link = F.struct(
        "link_pos",
        F.array(
            F.struct(F.lit("Item_ID").alias("key"), F.col("item_text").alias("value")),
            F.struct(F.lit("qty_used").alias("key"), F.col("qty_text").alias("value")),
            F.struct(F.lit("UoM").alias("key"), F.col("uom_text").alias("value")),
        ).alias("kv"),
    )
    full = (
        _derive(spark, sf_dir, MENU_LINKS, "part")
        .groupBy("Menu_ID", "Menu_Name", "Selling_Price_IDR", "menu_no")
        .agg(
            F.transform(
                F.sort_array(F.collect_list(link)), lambda e: F.map_from_entries(e["kv"])
            ).alias("ingredients")
        )
    )
    empty = full.filter("menu_no = 1").select(
        F.lit("MENU-026").alias("Menu_ID"), F.lit("Menu 26").alias("Menu_Name"), "Selling_Price_IDR",
        F.lit(26).alias("menu_no"), F.slice("ingredients", 1, 0).alias("ingredients"),
    )
    return full.unionByName(empty).withColumn("_ord", F.col("menu_no").cast("bigint")).drop("menu_no")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, EMPLOYEES, "supplier")
