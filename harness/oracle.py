"""SQL for every query, built on named parts that follow the reference rules.

``PARTS`` are common table expressions; a query text names the ones it needs.
"""

import re

from harness import inputs
from larder import defaults

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_TEXT = (
    "Transaction_ID", "DateTime", "Employee_ID", "Menu_ID", "Item_Name", "Quantity", "Additional_Info",
)
_ORDER = ", ".join(inputs.SALE_ORDER)


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _rows(pairs) -> str:
    return ", ".join(f"('{k}', cast({v} as double))" for k, v in pairs)


def _words() -> str:
    return " ".join(f"when '{w}' then {n}" for w, n in defaults.NUMBER_WORDS.items())


def _strip(column: str) -> str:
    return f"trim({column}, {_BLANKS})"


def _whole(text: str, table: str) -> str:
    return text.format(**{table: table})


PARTS = {
    "sales_text": _whole(inputs.SALES, "lineitem"),
    "sales": "select "
    + ", ".join(
        f"case when {c} in ({_quoted(defaults.SALES_NULLS)}) then null else {c} end as {c}" for c in _TEXT
    )
    + f", {_ORDER}, l_returnflag as dataset from sales_text",
    "texts": f"""select *, {_strip('DateTime')} as dt, lower({_strip('Quantity')}) as q,
        replace(lower({_strip('Quantity')}), ',', '.') as qn,
        lower({_strip('Additional_Info')}) as info from sales""",
    "numbers": r"""select *,
        case when regexp_full_match(dt, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+\d{2}:\d{2}')
               then try_strptime(substr(dt, 1, 19), '%Y-%m-%dT%H:%M:%S')
             when regexp_full_match(dt, '\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?')
               then try_strptime(dt, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d'])
             when regexp_full_match(dt, '\d{12}') then try_strptime(dt, '%Y%m%d%H%M')
             when regexp_full_match(dt, '\d{8}') then try_strptime(dt, '%Y%m%d')
             when regexp_full_match(dt, '\d{10}') then null
             else try_strptime(dt, ['%d/%m/%Y %H:%M', '%m/%d/%Y %I:%M %p', '%m-%d-%Y %I:%M %p',
               '%b %d %Y', '%Y/%m/%d %H:%M', '%d-%b-%Y %H:%M:%S', '%m.%d.%Y', '%d.%m.%Y'])
        end as stamp,
        case when regexp_full_match(qn, '[+-]?(\d[\d_]*(\.\d*)?|\.\d+)(e[+-]?\d+)?') then try_cast(qn as double)
             when regexp_full_match(qn, '[+]?inf(inity)?') then 'infinity'::double
             when regexp_full_match(qn, '-inf(inity)?') then '-infinity'::double end as layer_1,
        cast(case q """ + _words() + r""" end as double) as layer_2,
        try_cast(replace(nullif(regexp_extract(q, '(\d+[.,]?\d*)', 1), ''), ',', '.') as double) as layer_3
        from texts""",
    "parsed": f"""select * exclude (stamp),
        case when stamp between timestamp '1677-09-21 00:12:44' and timestamp '2262-04-11 23:47:16'
          then stamp end as parsed_stamp,
        case when q in ({_quoted(defaults.QUANTITY_BLANKS)}) then null
          when layer_1 is not null then case when isfinite(layer_1) and layer_1 >= 0 then layer_1 end
          else coalesce(layer_2, layer_3) end as parsed_quantity,
        coalesce(layer_1 < 0, false) as negative,
        coalesce({" or ".join(f"starts_with(info, '{word}')" for word in defaults.ERROR_PREFIXES)}, false) as error_flag,
        DateTime is null or Menu_ID is null or Quantity is null as missing
        from numbers""",
    "numbered": f"""select *, row_number() over (partition by Transaction_ID order by {_ORDER}) as copy_no
        from parsed""",
    "reasons": """select *,
        case when copy_no > 1 then 'DUPLICATE_TRANSACTION_ID'
          when error_flag then 'ERROR_FLAG_IN_ADDINFO'
          when missing then 'NULL_CRITICAL_FIELD'
          when parsed_stamp is null then 'UNPARSEABLE_DATE'
          when negative then 'NEGATIVE_QUANTITY'
          when parsed_quantity is null then 'UNPARSEABLE_QUANTITY'
          when parsed_quantity = 0 then 'ZERO_QUANTITY' end as Quarantine_Reason
        from numbered""",
    "tagged": """select *,
        case when coalesce(Quarantine_Reason, 'ZERO_QUANTITY') in
            ('NEGATIVE_QUANTITY', 'UNPARSEABLE_QUANTITY', 'ZERO_QUANTITY') then parsed_stamp end as DateTime_Parsed,
        cast(case when coalesce(Quarantine_Reason, 'ZERO_QUANTITY') in
            ('NEGATIVE_QUANTITY', 'UNPARSEABLE_QUANTITY', 'ZERO_QUANTITY') then parsed_stamp end as date) as Date,
        case when coalesce(Quarantine_Reason, 'ZERO_QUANTITY') in
            ('NEGATIVE_QUANTITY', 'UNPARSEABLE_QUANTITY', 'ZERO_QUANTITY') then parsed_quantity end as Quantity_Clean
        from reasons""",
    "links": _whole(inputs.MENU_LINKS, "part"),
    "menu_rows": """select Menu_ID, Menu_Name, Selling_Price_IDR, count(*) as n from links group by 1, 2, 3
        union all select 'MENU-026', 'Menu 26', Selling_Price_IDR, 0 from links where menu_no = 1
          group by Selling_Price_IDR""",
    "bom": f"""select * from (select {_strip('Menu_ID')} as Menu_ID, {_strip('item_text')} as Item_ID,
          try_cast(qty_text as double) as qty_used, lower({_strip('uom_text')}) as BOM_UoM from links)
        where Item_ID is not null and isfinite(qty_used)""",
    "known_menus": "select distinct Menu_ID from bom",
    "employee_rows": _whole(inputs.EMPLOYEES, "supplier"),
    "known_employees": f"""select distinct {_strip('Employee_ID')} as Employee_ID from employee_rows
        where Employee_ID is not null and Employee_ID <> ''""",
    "clean": f"""select Transaction_ID, DateTime_Parsed, Date, Quantity_Clean, dataset,
          {_strip('t.Menu_ID')} as Menu_ID,
          {_strip("coalesce(t.Employee_ID, 'UNKNOWN')")} as Employee_ID,
          {_strip('t.Menu_ID')} not in (select Menu_ID from known_menus) as is_ghost_menu,
          {_strip("coalesce(t.Employee_ID, 'UNKNOWN')")} not in (select Employee_ID from known_employees)
            as is_unknown_employee
        from tagged t where Quarantine_Reason is null""",
    "entries": _whole(inputs.STOCK_ENTRIES, "orders"),
    "entry_values": f"""select *,
          cast(case when date_text like '__/__/____' then try_strptime(date_text, '%m/%d/%Y')
            else try_strptime(substr(date_text, 1, 10), '%Y-%m-%d') end as date) as Date,
          row_number() over (partition by record_id order by entry_pos) - 1 as pos,
          {_strip('item_text')} as Item_ID, lower({_strip('uom_text')}) as UoM,
          case when key_name <> 'hidden' then count_text end as stock_text,
          case delivery_key when 'set' then try_cast(delivery_text as double) else 0 end as delivery
        from entries""",
    "flat": """select Date, Item_ID, UoM, rec_ord, entry_pos, record_id, pos,
          case when not isnan(try_cast(stock_text as double)) then try_cast(stock_text as double) end as raw_stock,
          delivery as delivery_in
        from entry_values
        where Date is not null and Item_ID is not null and try_cast(stock_text as double) is not null
          and delivery is not null""",
    "stock": "select *, case when raw_stock < 0 then 0 else raw_stock end as stock_remaining from flat",
    "inventory_text": _whole(inputs.INVENTORY, "part"),
    "items": f"""select {_strip('Item_ID')} as Item_ID, {_strip('Item_Name')} as Item_Name, Supplier_UoM,
          coalesce(try_cast(Min_Stock_Threshold as double), 0) as Min_Stock_Threshold, Category, inv_ord
        from inventory_text where Item_ID is not null""",
    "cartons": f"select * from (values {_rows(defaults.CARTON_UNITS.items())}) v(Item_ID, Carton_Units)",
    "costs": f"select * from (values {_rows(defaults.UNIT_COSTS.items())}) v(Item_ID, Unit_Cost)",
    "levels": f"""select i.*, c.Carton_Units,
          case {_strip('Supplier_UoM')} when 'Kilogram' then Min_Stock_Threshold * 1000
            when 'Liter' then Min_Stock_Threshold * 1000 when 'Pcs' then Min_Stock_Threshold
            when 'Karton' then coalesce(Min_Stock_Threshold * Carton_Units, 20000) else 20000 end as Min_Threshold
        from items i left join cartons c on c.Item_ID = i.Item_ID""",
    "thresholds": "select Item_ID, arg_max(Min_Threshold, inv_ord) as Min_Threshold from levels group by 1",
    "menu_days": """select Date, Menu_ID, is_ghost_menu, sum(Quantity_Clean) as Quantity_Clean,
          count(Transaction_ID) as Transaction_Count from clean group by 1, 2, 3""",
    "used": """select Date, Item_ID, sum(Quantity_Clean * qty_used) as POS_Consumed
        from clean join bom using (Menu_ID) group by 1, 2""",
    "recon": """select *, stock_remaining - Expected_Stock as Variance from (
          select *, Prev_Physical + delivery_in - POS_Consumed as Expected_Stock from (
            select s.*, coalesce(u.POS_Consumed, 0) as POS_Consumed,
              lag(stock_remaining) over (partition by s.Item_ID order by s.Date, rec_ord, entry_pos)
                as Prev_Physical
            from stock s left join used u on u.Date = s.Date and u.Item_ID = s.Item_ID))""",
    "classified": f"""select *, case when Action_Status <> 'Anomaly' then 'N/A' when Variance < 0 then 'Shrinkage'
            else 'POS_Overcount' end as Variance_Direction from (
          select r.*, coalesce(t.Min_Threshold, 20000) as Min_Threshold,
            case when abs(Variance) > 1000 then 'Anomaly'
              when stock_remaining < coalesce(t.Min_Threshold, 20000) then 'Restock' else 'Safe' end as Action_Status,
            case when r.Item_ID in ({_quoted(defaults.NO_RECIPE_ITEMS)}) then '{defaults.NO_RECIPE_NOTE}' else '' end
              as Item_Note
          from recon r left join thresholds t on t.Item_ID = r.Item_ID)""",
    "invalid": f"""select Date, Menu_ID as Item_ID, Quantity_Clean as Quantity_Total, Transaction_Count,
          'Invalid Data' as Action_Status, 'N/A' as Variance_Direction,
          '{defaults.INVALID_NOTE}' as Item_Note from menu_days where is_ghost_menu""",
    "core": """select Date, Item_ID, Action_Status, stock_remaining as Physical_Stock, Expected_Stock, Variance,
          Variance_Direction, POS_Consumed, delivery_in as Delivery_In, Min_Threshold, Item_Note from classified
        union all select Date, Item_ID, Action_Status, null, null, null, Variance_Direction, null, null, null,
          Item_Note from invalid""",
    "grid": """select d.Date, i.Item_ID, coalesce(u.POS_Consumed, 0) as POS_Consumed
        from (select cast(unnest(generate_series(min(Date), max(Date), interval 1 day)) as date) as Date from used) d
        cross join (select distinct Item_ID from used) i
        left join used u on u.Date = d.Date and u.Item_ID = i.Item_ID""",
    "means": """select Date, Item_ID, sum(POS_Consumed) over w / count(*) over w as Avg_7d_Consumption
        from grid window w as (partition by Item_ID order by Date rows between 6 preceding and current row)""",
    "forecast": """select c.*, m.Avg_7d_Consumption from core c
        left join means m on m.Date = c.Date and m.Item_ID = c.Item_ID""",
    "stockout": """select *, case when Physical_Stock is null or not coalesce(Avg_7d_Consumption > 0, false) then null
            when Physical_Stock - Min_Threshold <= 0 then 0
            else cast(printf('%.1f', (Physical_Stock - Min_Threshold) / Avg_7d_Consumption) as double) end
            as Days_to_Stockout from forecast""",
    "urgency": """select *, case when Days_to_Stockout is null then 'N/A' when Days_to_Stockout = 0 then 'CRITICAL'
            when Days_to_Stockout <= 3 then 'URGENT' when Days_to_Stockout <= 7 then 'PLAN_ORDER'
            else 'SUFFICIENT' end as Restock_Urgency from stockout""",
    "report": """select Date, u.Item_ID, Action_Status, Physical_Stock, Min_Threshold, Days_to_Stockout,
          Restock_Urgency, Expected_Stock, Variance, Variance_Direction,
          case when Variance_Direction = 'Shrinkage' and Unit_Cost > 0
            then round_even(abs(Variance) * Unit_Cost, 0) end as Estimated_Loss_IDR,
          POS_Consumed, Avg_7d_Consumption, Delivery_In, Item_Note
        from urgency u left join costs c on c.Item_ID = u.Item_ID""",
}


def _needed(text: str) -> list[str]:
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\b\w+\b", todo.pop()))
        for name in PARTS:
            if name in words and name not in found:
                found.add(name)
                todo.append(PARTS[name])
    return [name for name in PARTS if name in found]


def with_parts(text: str) -> str:
    names = _needed(text)
    if not names:
        return text
    return "with " + ",\n".join(f"{n} as ({PARTS[n]})" for n in names) + "\n" + text


_SALES_COLUMNS = ", ".join(_TEXT)
_REASON_COUNTS = ", ".join(
    f"count(*) filter (Quarantine_Reason = '{r}') as {r.lower()}"
    for r in (
        defaults.DUPLICATE, defaults.ERROR_FLAG, defaults.NULL_FIELD, defaults.BAD_DATE,
        defaults.NEGATIVE, defaults.BAD_QUANTITY, defaults.ZERO,
    )
)
_TRIAGE = " ".join(f"when '{r}' then '{c}'" for r, c, _ in defaults.TRIAGE)
_RECOVERY = " ".join(f"when '{r}' then '{p}'" for r, _, p in defaults.TRIAGE)
PIVOT_ITEMS = [f"INV-{n:04d}" for n in range(1, 41)]
def _glob(shape: str) -> str:
    """A test of a text's beginning: 9 stands for a digit, A and a for letters, the rest for itself."""
    classes = {"9": "[0-9]", "A": "[A-Z]", "a": "[a-z]"}
    return f"array_to_string(string_split_regex(dt, '\\s+'), ' ') glob '{''.join(classes.get(c, c) for c in shape)}*'"


_SHAPES = {
    "9999-99-99 99:99:99": "ISO YYYY-MM-DD HH:MM:SS", "99/99/9999": "DD/MM/YYYY", "Aaa 9 9999": "Month DD YYYY",
    "Aaa 99 9999": "Month DD YYYY", "999999999999": "Compact 12-digit",
    "99-99-9999 99:99 [AP]M": "MM-DD-YYYY AM/PM",
}
_DATE_CLASS = "case when coalesce(dt, '') = '' then 'EMPTY' " + " ".join(
    f"when {_glob(shape) if '[' not in shape else _glob(shape[:17]).replace('*', '[AP]M*')} then '{name}'"
    for shape, name in _SHAPES.items()
) + " else 'OTHER' end"

QUERIES = {
    "s01_csv_scan": f"select {_SALES_COLUMNS} from sales",
    "s02_stock_scan": """select record_id, date_text as date, recorded_by, count(*) as entries
        from entries group by 1, 2, 3""",
    "s03_inventory_scan": "select Item_ID, Item_Name, Supplier_UoM, Min_Stock_Threshold, Category from items",
    "s04_menu_scan": "select Menu_ID, Menu_Name, Selling_Price_IDR, cast(n as bigint) as links from menu_rows",
    "s05_employee_scan": "select * from employee_rows",
    "s06_source_policy": """select 'sales' as source, true as required, count(*) as rows from sales
        union all select 'stock', true, count(distinct record_id) from entries
        union all select 'inventory', true, count(*) from items
        union all select 'menus', true, count(*) from menu_rows
        union all select 'employees', false, 0""",
    "s07_report_sink": "select * from report",
    "s08_quarantine_sink": """select Quarantine_Reason, count(*) as rows from tagged
        where Quarantine_Reason is not null group by 1""",
    "c01_null_tokens": f"select {_SALES_COLUMNS} from sales",
    "c02_keep_first": f"select Transaction_ID, {_ORDER}, copy_no > 1 as is_duplicate from numbered",
    "c03_error_flag": "select Additional_Info, error_flag, count(*) as rows from parsed group by 1, 2",
    "c04_missing_critical": """select DateTime is null as no_date, Menu_ID is null as no_menu,
        Quantity is null as no_quantity, missing, count(*) as rows from parsed group by 1, 2, 3, 4""",
    "c05_parse_timestamp": """select DateTime, parsed_stamp as DateTime_Parsed, count(*) as rows
        from parsed group by 1, 2""",
    "c06_bad_dates": """select DateTime, count(*) as rows from parsed
        where DateTime is not null and parsed_stamp is null group by 1""",
    "c07_dates": "select cast(parsed_stamp as date) as Date, count(*) as rows from parsed group by 1",
    "c08a_quantity_number": "select Quantity, layer_1 as value, count(*) as rows from parsed group by 1, 2",
    "c08b_quantity_word": "select Quantity, layer_2 as value, count(*) as rows from parsed group by 1, 2",
    "c08c_quantity_in_text": "select Quantity, layer_3 as value, count(*) as rows from parsed group by 1, 2",
    "c08_parse_quantity": """select Quantity, parsed_quantity as Quantity_Clean, count(*) as rows
        from parsed group by 1, 2""",
    "c09_negative_quantity": "select Quantity, count(*) as rows from parsed where negative group by 1",
    "c10_bad_quantity": """select Quantity, count(*) as rows from parsed
        where parsed_quantity is null and not negative group by 1""",
    "c11_zero_quantity": "select Quantity, count(*) as rows from parsed where parsed_quantity = 0 group by 1",
    "c12_valid_sales": """select Transaction_ID, DateTime_Parsed, Menu_ID, Quantity_Clean from tagged
        where Quarantine_Reason is null""",
    "c13_unknown_menus": "select Menu_ID, is_ghost_menu, count(*) as rows from clean group by 1, 2",
    "c14_unknown_employees": "select Employee_ID, is_unknown_employee, count(*) as rows from clean group by 1, 2",
    "c13_unknown_menu_counts": "select Menu_ID, count(*) as rows from clean where is_ghost_menu group by 1",
    "c14_unknown_employee_counts": "select Employee_ID, count(*) as rows from clean where is_unknown_employee group by 1",
    "c15_tagged_sales": f"""select {_SALES_COLUMNS}, DateTime_Parsed, Date, Quantity_Clean, Quarantine_Reason
        from tagged""",
    "c16_metrics": f"""select count(*) as raw_rows, {_REASON_COUNTS},
        count(*) filter (Quarantine_Reason is null) as valid_rows,
        count(Quarantine_Reason) as quarantined_rows,
        (select count(*) from clean where is_ghost_menu) as unknown_menu_rows,
        (select count(*) from clean where is_unknown_employee) as unknown_employee_rows from tagged""",
    "w01_flatten_stock": """select Date, Item_ID, raw_stock as stock_remaining, delivery_in, UoM from flat""",
    "w02_key_drift": "select record_id, pos, stock_text from entry_values",
    "w03_typed_entries": """select record_id, count(*) as entries, sum(raw_stock) as stock, sum(delivery_in) as delivered
        from flat group by 1""",
    "w04_labels": "select Item_ID, UoM, count(*) as rows from flat group by 1, 2",
    "w05_record_dates": """select date_text as date, Date as day, count(distinct record_id) as records
        from entry_values group by 1, 2""",
    "w06_clip_negative": """select Date, Item_ID, raw_stock, stock_remaining from stock""",
    "w07_stock_profile": """select count(*) as rows, count(distinct Date) as days, count(distinct Item_ID) as items,
        count(*) filter (raw_stock < 0) as negative_rows,
        count(*) - count(distinct (Date, Item_ID)) as repeated_rows from stock""",
    "d01_unit_conversion": """select Item_ID, Supplier_UoM, Min_Stock_Threshold, Min_Threshold,
        case when trim(Supplier_UoM) = 'Karton' and Carton_Units is null then 'NO_CARTON_UNITS'
          when coalesce(trim(Supplier_UoM), '') not in ('Karton', 'Kilogram', 'Liter', 'Pcs') then 'UNKNOWN_UNIT'
        end as Fallback_Reason from levels""",
    "d02_last_threshold": "select * from thresholds",
    "d03_recipe_links": "select Menu_ID, Item_ID, qty_used, BOM_UoM from bom",
    "d04_known_employees": "select * from known_employees",
    "d05_known_menus": "select * from known_menus",
    "d06_carton_units": """select distinct Item_ID, Carton_Units from levels
        where trim(Supplier_UoM) = 'Karton'""",
    "d07_unit_costs": """select distinct i.Item_ID, c.Unit_Cost from items i left join costs c on c.Item_ID = i.Item_ID""",
    "d08_no_recipe": "select distinct Item_ID from items where Item_ID not in (select Item_ID from bom)",
    "j01_known_sales": """select Menu_ID, count(*) as rows, sum(Quantity_Clean) as quantity from clean
        where not is_ghost_menu group by 1""",
    "j02_expand_recipes": """select Menu_ID, Item_ID, count(*) as rows from clean join bom using (Menu_ID)
        group by 1, 2""",
    "j03_consumed": """select Transaction_ID, Date, Item_ID, Quantity_Clean * qty_used as Total_Consumed
        from clean join bom using (Menu_ID)""",
    "j04_daily_consumption": "select * from used",
    "j05_consumption_profile": """select count(*) as rows, count(distinct Date) as days,
        count(distinct Item_ID) as items from used""",
    "j06_previous_count": "select Date, Item_ID, rec_ord, pos, stock_remaining, Prev_Physical from recon",
    "j07_attach_consumption": "select Date, Item_ID, rec_ord, stock_remaining, POS_Consumed from recon",
    "j08_orphan_days": """select Date, count(*) as days, sum(c) as POS_Consumed from (
          select Date, sum(POS_Consumed) as c from used where Date not in (select Date from stock) group by 1)
        group by rollup (Date)""",
    "j08_orphan_items": """select u.Date, u.Item_ID, u.POS_Consumed from used u
        where not exists (select 1 from stock s where s.Date = u.Date and s.Item_ID = u.Item_ID)""",
    "j09_expected_stock": "select Date, Item_ID, rec_ord, Expected_Stock from recon",
    "j10_variance": "select Date, Item_ID, rec_ord, Expected_Stock, Variance from recon",
    "j10_variance_profile": """select count(*) as rows, count(Variance) as analysable_rows,
        count(*) filter (Variance is null) as skipped_rows from recon""",
    "k01_invalid_groups": "select * from invalid",
    "k02_status": "select Date, Item_ID, rec_ord, Variance, stock_remaining, Action_Status from classified",
    "k03_direction": "select Date, Item_ID, rec_ord, Action_Status, Variance_Direction from classified",
    "k04_notes": "select Item_ID, Item_Note, count(*) as rows from classified group by 1, 2",
    "k05_thresholds": "select Item_ID, Min_Threshold, count(*) as rows from classified group by 1, 2",
    "k06_status_counts": """select Action_Status, Variance_Direction, count(*) as rows,
        cast(grouping(Action_Status, Variance_Direction) as int) as level
        from core group by rollup (Action_Status, Variance_Direction)""",
    "k07_core_columns": "select * from core where Action_Status <> 'Invalid Data'",
    "k08_bind_invalid": "select * from core",
    "k09_sorted_report": "select * from core",
    "b01_dense_grid": """select Date, Item_ID, POS_Consumed,
          cast(count(*) over (partition by Item_ID, run) - 1 as int) as zero_days
        from (select Date, Item_ID, POS_Consumed, sum(case when used_day or Date = start then 1 else 0 end)
              over (partition by Item_ID order by Date) as run
            from (select g.*, u.Date is not null as used_day, min(g.Date) over () as start
              from grid g left join used u on u.Date = g.Date and u.Item_ID = g.Item_ID) g)
        qualify row_number() over (partition by Item_ID, run order by Date) = 1""",
    "b02_trailing_mean": """select s.Date, s.Item_ID, s.rec_ord, m.Avg_7d_Consumption from stock s
        left join means m on m.Date = s.Date and m.Item_ID = s.Item_ID""",
    "b03_unpivot": "select Date, Item_ID, Avg_7d_Consumption from means where Avg_7d_Consumption <> 0",
    "b03w_pivot": "select Date, "
    + ", ".join(f"coalesce(sum(POS_Consumed) filter (Item_ID = '{i}'), 0) as \"{i}\"" for i in PIVOT_ITEMS)
    + " from used group by Date",
    "b04_attach_forecast": "select Date, Item_ID, Action_Status, Physical_Stock, Avg_7d_Consumption from forecast",
    "b05_days_to_stockout": """select Date, Item_ID, Physical_Stock, Min_Threshold, Avg_7d_Consumption,
        Days_to_Stockout from stockout""",
    "b06_urgency": "select Restock_Urgency, Days_to_Stockout, count(*) as rows from urgency group by 1, 2",
    "b07_urgent_count": """select count(*) filter (Restock_Urgency in ('CRITICAL', 'URGENT')) as urgent_rows
        from urgency""",
    "b08_loss": """select Date, Item_ID, Variance, Estimated_Loss_IDR from report
        where Estimated_Loss_IDR is not null""",
    "b09_loss_summary": """select coalesce(sum(Estimated_Loss_IDR), 0) as total_loss,
        count(Estimated_Loss_IDR) as rows from report""",
    "b10_action_report": "select * from report",
    "b11_run_summary": """select Action_Status, Variance_Direction, count(*) as rows,
        cast(grouping(Action_Status, Variance_Direction) as int) as level
        from report group by rollup (Action_Status, Variance_Direction)""",
    "a01_key_profile": f"""select cast(sum(n) as bigint) as rows,
        cast(coalesce(sum(n) filter (id = ''), 0) as bigint) as empty,
        cast(coalesce(sum(n - 1) filter (id <> ''), 0) as bigint) as repeated,
        count(*) filter (id <> '') as distinct_ids
        from (select coalesce({_strip('Transaction_ID')}, '') as id, count(*) as n from sales_text group by 1)""",
    "a02_emptiness": f"""select count(*) filter (coalesce({_strip('Employee_ID')}, '') = '') as empty_employee_id,
        count(*) filter (coalesce({_strip('Menu_ID')}, '') = '') as empty_menu_id from sales_text""",
    "a03_quantity_profile": r"""select count(*) filter (q = '') as empty, count(*) filter (v = 0) as zero,
        count(*) filter (v < 0) as negative, count(*) filter (q <> '' and v is null) as unparseable from (
          select q, case when regexp_full_match(q, '[+-]?(\d[\d_]*(\.\d*)?|\.\d+)(e[+-]?\d+)?') then try_cast(q as double)
            when q in ('inf', 'infinity') then 'infinity'::double
            when q in ('-inf', '-infinity') then '-infinity'::double end as v
          from (select coalesce(replace(lower("""
    + _strip("Quantity")
    + """), ',', '.'), '') as q from sales_text))""",
    "a04_date_formats": f"""select format, rows, rows / (sum(rows) over ()) as share from (
          select {_DATE_CLASS} as format, count(*) as rows
          from (select {_strip('DateTime')} as dt from sales_text) group by 1)""",
    "a05_unknown_dates": f"""select DateTime from (select DateTime, {_strip('DateTime')} as dt from sales_text)
        where {_DATE_CLASS} = 'OTHER'""",
    "a06_stock_drift": """select count(*) as records, count(*) filter (o) as old_key_records,
          count(*) filter (n) as new_key_records, count(distinct date_text) as days, min(date_text) as first_day,
          max(date_text) as last_day from (
        select record_id, date_text, bool_or(key_name in ('old', 'both', 'hidden')) as o,
          bool_or(key_name in ('new', 'both', 'hidden')) as n from entries group by 1, 2)""",
    "a07_units": f"""select {_strip('Supplier_UoM')} as unit, count(*) as items,
        {_strip('Supplier_UoM')} = 'Karton' as is_carton from inventory_text group by 1, 3""",
    "a08_menu_profile": """select count(*) as menus, cast(sum(n) as bigint) as links,
        cast(sum(n) as double) / count(*) as links_per_menu from menu_rows""",
    "a09_employees": "select Employee_ID, Full_Name, Role from employee_rows",
    "a10_source_summary": f"""select 'sales' as source, count(*) as rows, cast(null as bigint) as part_1,
          cast(null as bigint) as part_2 from sales_text
        union all select 'stock', count(*), count(*) filter (o), count(*) filter (n) from (
          select record_id, bool_or(key_name in ('old', 'both', 'hidden')) as o,
            bool_or(key_name in ('new', 'both', 'hidden')) as n from entries group by 1)
        union all select 'inventory', count(*), count(*) filter ({_strip('Supplier_UoM')} = 'Karton'),
          count(*) filter ({_strip('Supplier_UoM')} <> 'Karton') from inventory_text
        union all select 'menus', count(*), null, null from menu_rows
        union all select 'employees', count(*), null, null from employee_rows""",
    "t01_triage": f"""select Triage_Class, Recovery, rows, Recovery <> 'NONE' as recoverable,
          rows / (sum(rows) over ()) as share from (
        select case Quarantine_Reason {_TRIAGE} end as Triage_Class,
          case Quarantine_Reason {_RECOVERY} end as Recovery, count(*) as rows
        from tagged where Quarantine_Reason is not null group by 1, 2)""",
    "t02_outlier_bound": """select q1, q3, q3 - q1 as iqr, q3 + 1.5 * (q3 - q1) as upper_bound from (
        select quantile_cont(Variance, 0.25) as q1, quantile_cont(Variance, 0.75) as q3 from recon)""",
    "t03_reason_shares": """select Quarantine_Reason, rows, rows / (sum(rows) over ()) as share_of_quarantine,
          rows / (select count(*) from tagged) as share_of_total from (
        select Quarantine_Reason, count(*) as rows from tagged where Quarantine_Reason is not null group by 1)""",
    "t03_status_shares": """select Action_Status, rows, rows / (sum(rows) over ()) as share from (
        select Action_Status, count(*) as rows from core group by 1)""",
    "t04_item_rates": f"""select Item_ID, sales, rejected, rejected / sales as rate,
          case when rejected / sales < 0.05 then 'LOW' when rejected / sales > 0.2 then 'HIGH' else 'MEDIUM' end as band
        from (select b.Item_ID, count(*) as sales, count(Quarantine_Reason) as rejected
          from (select {_strip('Menu_ID')} as Menu_ID, Quarantine_Reason from tagged) s
          join bom b on b.Menu_ID = s.Menu_ID group by 1)""",
    "t05_role_views": """select unnest(['manager_restock', 'manager_anomaly', 'purchasing', 'finance', 'operations',
          'analyst']) as role, unnest([
        count(*) filter (Action_Status = 'Restock' and Restock_Urgency = 'CRITICAL'),
        count(*) filter (Action_Status = 'Anomaly'),
        count(*) filter (Action_Status = 'Restock' and Restock_Urgency = 'PLAN_ORDER'),
        count(Estimated_Loss_IDR), count(*) filter (Variance_Direction = 'Shrinkage'),
        count(*) filter (Action_Status = 'Invalid Data')]) as rows from report""",
    "t06_datasets": f"""select dataset, rows, quarantined, clean, quarantined / rows as dirty_rate,
          (select count(*) from stock) + coalesce(invalid, 0) as report_rows
        from (select dataset, count(*) as rows, count(r) as quarantined, count(*) - count(r) as clean,
            count(distinct case when r is null and m not in (select Menu_ID from known_menus) then (d, m) end) as invalid
          from (select dataset, {_strip('Menu_ID')} as m, cast(parsed_stamp as date) as d,
            case when row_number() over (partition by dataset, Transaction_ID order by {_ORDER}) > 1
                or error_flag or missing or parsed_stamp is null or parsed_quantity is null or parsed_quantity = 0
              then 'x' end as r from parsed) group by dataset)""",
}


def _audit() -> str:
    """The profiles of the sales one after the other, each as rows of (profile, part, rows)."""
    parts = {
        "ids": ("a01_key_profile", ("rows", "empty", "distinct_ids", "repeated")),
        "emptiness": ("a02_emptiness", ("empty_employee_id", "empty_menu_id")),
        "quantity": ("a03_quantity_profile", ("empty", "zero", "negative", "unparseable")),
    }
    selects = [
        f"select '{name}' as profile, '{part}' as part, cast(coalesce({part}, 0) as bigint) as rows from ({QUERIES[query]})"
        for name, (query, columns) in parts.items() for part in columns
    ]
    formats = ", ".join(f"('{c}')" for c in ("EMPTY", *defaults.DATE_CLASSES, "OTHER"))
    selects.append(f"""select 'dates', c, cast(coalesce(rows, 0) as bigint) from (values {formats}) classes(c)
        left join ({QUERIES['a04_date_formats']}) found on found.format = classes.c""")
    return " union all ".join(selects)


QUERIES["a11_sales_audit"] = _audit()


def oracle_sql() -> dict[str, str]:
    return {name: with_parts(text) for name, text in QUERIES.items()}
