"""Order-sheet queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.merchandising import collection_metrics
from storelens.catalog.registry import Catalog
from storelens.catalog.segments import customers
from storelens.catalog.views import AS_OF, RetailTables
from storelens.functions.dates import with_ship_date
from storelens.functions.text import match_name, upper_key
from storelens.operators.cleaning import preprocess_strings
from storelens.operators.joins import keys_in_both, keys_only_left, match_stats, value_counts
from storelens.operators.reshape import size_columns, unpivot_sizes
from storelens.plans import order_sheets as o
from storelens.session import shared_dir, stage, stored_inside
from storelens.sources.files import read_text_csvs

# Invented sales representatives by file prefix.
REPS = {"JC": "Robin North", "AK": "Sam East", "AG": "Kim South", "CF": "Lou West"}

MASTER_COLUMNS = (
    "row_no, sku_parent, size_abbreviation, sku, upc, collection, season, faho24_status, ext_id"
)


def master(t: RetailTables) -> DataFrame:
    return o.master_ext_id(t.master_rows, t.variant_export)


def filtered(t: RetailTables) -> DataFrame:
    return o.master_filtered(master(t))


def lookup(t: RetailTables) -> DataFrame:
    return o.orderable(o.master_unique(filtered(t)))


def sheet(t: RetailTables) -> DataFrame:
    return o.clean_sheet(t.order_sheet)


def groups(t: RetailTables) -> DataFrame:
    return o.order_groups(sheet(t))


def sizes(t: RetailTables) -> dict[str, str]:
    return size_columns(t.order_sheet.columns, filtered(t), "size_abbreviation")


def items(t: RetailTables) -> DataFrame:
    return o.order_items(groups(t), sizes(t))


def enriched(t: RetailTables) -> DataFrame:
    return o.order_items_enriched(items(t), lookup(t))


def matches(t: RetailTables) -> DataFrame:
    return o.contact_match(o.order_starts(sheet(t), AS_OF).select("customer"), t.contacts)


def name_pieces(t: RetailTables) -> DataFrame:
    """Pieces of contact names, of one letter and more, as names to look for."""
    row = F.col("row_no")
    piece = F.substring(F.col("name"), 1 + (row % 3).cast("int"), 1 + (row % 13).cast("int"))
    return t.contacts.select(piece.alias("customer")).filter(F.trim("customer") != "").distinct()


def order_import(t: RetailTables) -> DataFrame:
    """Tables stored in between are deleted as soon as the next one is there."""
    with stored_inside() as cleaned:
        table = stage(sheet(t), "sheet")
    with stored_inside() as carried:
        rows = o.order_groups(table)
    cleaned.remove()
    named = sizes(t)
    found = o.order_items_enriched(o.order_items(rows, named, packed=True), lookup(t), named)
    # what items were found by is not in the table
    stored = stage(found.drop("parent", "size", "barcode"), "order_items")
    imported = o.order_import(stored, rows, t.contacts, AS_OF, REPS)
    carried.remove()
    return imported


def import_files(t: RetailTables) -> DataFrame:
    with stored_inside() as passing:
        rows = order_import(t)
    return o.import_files(rows, passing=passing)


def sheet_folder(t: RetailTables) -> DataFrame:
    """Sheets with their own size columns, in different orders and two encodings,
    written to one folder, read back and brought to long form."""
    path = shared_dir(t.spark, "sheets")
    line = t.lineitem
    who = F.concat(F.lit("Café "), F.col("l_suppkey").cast("string")).alias("Customer")
    parent = F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("Parent SKU")
    units = F.col("l_quantity").cast("int").cast("string")
    number = (F.col("l_linenumber") - 1).cast("string")
    kinds = (
        ("UTF-8", [who, parent, units.alias("S"), number.alias("M")]),
        ("ISO-8859-1", [parent, who, number.alias("M"), units.alias("QTY S"), F.lit("1").alias("L")]),
        ("UTF-8", [who, F.lit("x").alias("Other"), parent, units.alias("XL")]),
    )
    for kind, (encoding, columns) in enumerate(kinds):
        rows = line.filter(F.col("l_orderkey") % 3 == kind).select(*columns)
        rows.write.mode("append").csv(path, header=True, encoding=encoding)
    sheets = o.clean_sheet(read_text_csvs(t.spark, path, own_headers=True))
    named = {"S": "S", "M": "M", "L": "L", "XL": "XL", "QTY S": "S"}
    return unpivot_sizes(sheets, ["customer"], named)


def all_match_stats(t: RetailTables) -> DataFrame:
    """The match rates the chains report: emails, external ids, collections, contacts."""
    skus = master(t).groupBy("sku").agg(F.max("ext_id").alias("ext_id"))
    refs = o.variant_export_dedup(t.variant_export).select(F.col("internal_reference").alias("sku"))
    both = skus.join(refs.withColumn("known", F.lit(True)), "sku", "left")
    parts = [
        match_stats(customers(t), F.col("profile_id").isNotNull(), "email"),
        match_stats(both, F.col("known").isNotNull(), "external id"),
        match_stats(collection_metrics(t), F.col("rate_of_sale_30d").isNotNull(), "collection"),
        match_stats(matches(t), F.col("id") != "", "contact"),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def register(c: Catalog) -> None:
    # -- shared SQL -----------------------------------------------------------
    c.part(
        "export_ids",
        """select internal_reference, id from (
             select upper(trim(internal_reference)) as internal_reference, trim(id) as id,
                    row_number() over (partition by upper(trim(internal_reference)) order by trim(id) = '', row_no) as nth
             from variant_export) e where nth = 1""",
    )
    c.part(
        "master_ids",
        """select m.*, coalesce(e.id, '') as ext_id from (
             select row_no, upper(trim(sku_parent)) as sku_parent, upper(trim(size_abbreviation)) as size_abbreviation,
                    upper(trim(sku)) as sku, trim(upc) as upc, trim(collection) as collection, trim(season) as season,
                    trim(faho24_status) as faho24_status from master_rows) m
           left join export_ids e on m.sku = e.internal_reference""",
    )
    c.part(
        "master_kept",
        """select * replace (upper(collection) as collection, upper(season) as season, upper(faho24_status) as faho24_status)
           from master_ids
           where upper(season) <> 'EXCLUSIVE' and upper(faho24_status) <> 'EXCLUSIVE' and upper(collection) <> 'HAREM PANTS'
             and not contains(sku, 'HIC') and sku_parent not in ('', 'N/A', '#N/A', 'NA', 'NONE')
             and size_abbreviation not in ('', 'N/A', '#N/A', 'NA', 'NONE')""",
    )
    c.part(
        "master_one",
        """select * exclude (nth) from (
             select *, row_number() over (partition by sku_parent, size_abbreviation order by ext_id = '', upc = '', row_no) as nth
             from master_kept) r where nth = 1""",
    )
    c.part(
        "grouped_rows",
        """select *, last_value(case when customer <> '' then row_no end ignore nulls) over w as start_row
           from order_sheet window w as (partition by file order by row_no rows between unbounded preceding and current row)""",
    )
    cells = " union all ".join(
        f"""select file, row_no, start_row, parent_sku as parent, {pos} as size_pos, '{size}' as size,
                   try_cast({column} as double) as amount from grouped_rows"""
        for pos, (column, size) in enumerate((("s", "S"), ("m", "M"), ("l", "L"), ("osfm", "OSFM")))
    )
    c.part(
        "long_items",
        f"""select file, row_no, start_row, parent, size_pos, size, cast(trunc(amount) as bigint) as qty
            from ({cells}) x where amount <> 0 and parent <> ''""",
    )
    c.part(
        "found_items",
        """select i.*, coalesce(a.sku, b.sku) as sku, coalesce(a.upc, b.upc) as barcode, coalesce(a.ext_id, b.ext_id) as ext_id,
                  case when a.sku is not null then 0 when i.size = 'S' then 1 else 2 end as pass_no
           from long_items i left join master_one a on i.parent = a.sku_parent and i.size = a.size_abbreviation
           left join master_one b on i.parent = b.sku_parent and b.size_abbreviation = case i.size when 'S' then 'SM' when 'L' then 'LXL' end""",
    )

    def norm(x: str) -> str:
        return (
            f"trim(regexp_replace(regexp_replace(lower({x}), '[^\\w\\s]', '', 'g'), '\\s+', ' ', 'g'))"
        )

    c.part(
        "people",
        f"""select row_no, trim(name) as name, trim(id) as id, is_a_company = 'True' as company, {norm('name')} as normalized,
                   length(trim(name)) as name_length from contacts""",
    )
    c.part(
        "asked_names",
        f"select distinct customer, {norm('customer')} as normalized from order_sheet where customer <> ''",
    )
    picks = "count(*) as hits, count(*) filter (where company) as companies, arg_min(id, p.row_no) as first_id, arg_min(id, p.row_no) filter (where company) as company_id"
    c.part(
        "hits_exact",
        f"select a.customer, {picks} from asked_names a join people p on p.name = a.customer group by a.customer",
    )
    c.part(
        "hits_same",
        f"select a.customer, {picks} from asked_names a join people p on p.normalized = a.normalized group by a.customer",
    )
    c.part(
        "hits_part",
        f"""select a.customer, {picks}, arg_min(id, p.name_length * 10000000000 + p.row_no) filter (where company) as short_id
            from asked_names a join people p on contains(p.normalized, a.normalized) group by a.customer""",
    )
    c.part(
        "contact_results",
        """select a.customer,
                  case when e.hits > 0 then coalesce(e.company_id, e.first_id) when s.hits > 0 then coalesce(s.company_id, s.first_id)
                       when p.hits = 1 then p.first_id when p.companies = 1 then p.company_id when p.companies > 1 then p.short_id
                       when p.hits > 1 then p.first_id else '' end as id,
                  case when e.companies > 0 then '[Exact match, company]' when e.hits > 0 then '[Exact match]'
                       when s.companies > 0 then '[Normalized match, company]' when s.hits > 0 then '[Normalized match]'
                       when p.hits = 1 then concat('[Contains match, ', case when p.companies = 1 then 'company' else 'individual' end, ']')
                       when p.companies = 1 then '[Contains match, company, 1 of many]'
                       when p.companies > 1 then concat('[Contains match, company, 1 of ', p.companies, ']')
                       when p.hits > 1 then concat('[Contains match, 1 of ', p.hits, ']') else '[No match]' end as match_info
           from asked_names a left join hits_exact e on a.customer = e.customer left join hits_same s on a.customer = s.customer
           left join hits_part p on a.customer = p.customer""",
    )

    def clean_ship(raw: str) -> str:
        """Ship date of a text, null when it cannot be read."""
        text = f"trim({raw})"
        pattern = r"([0-9]{1,2})[/\-]([0-9]{1,2})(?:[/\-]([0-9]{2,4}))?"
        part = [f"regexp_extract({text}, '{pattern}', {i})" for i in (1, 2, 3)]
        month, day = part[0], part[1]
        year = f"try_cast({part[2]} as int)"
        full = f"case when {year} < 50 then {year} + 2000 when {year} < 100 then {year} + 1900 else {year} end"

        def on(y: str) -> str:
            return f"try_strptime(concat({y}, '-', {month}, '-', {day}), '%Y-%m-%d')"

        this = on(str(AS_OF.year))
        later = on(str(AS_OF.year + 1))
        return (
            f"case when upper({text}) = 'ASAP' or {month} = '' then null "
            f"when {part[2]} <> '' then {on(full)} when {this} < timestamp '{AS_OF}' then {later} else {this} end"
        )

    c.part(
        "sheet_starts",
        f"""select file, row_no as start_row, customer, ship_date as raw_ship_date, {clean_ship('ship_date')} as ship_on
            from order_sheet where customer <> ''""",
    )
    c.part(
        "notes_by_order",
        """select file, start_row, string_agg(rep_notes, ' --- ' order by row_no) as notes from grouped_rows
           where rep_notes <> '' and start_row is not null group by file, start_row""",
    )
    c.part(
        "files_seen",
        """select distinct file, upper(substring(file, 1, 2)) as prefix from order_sheet""",
    )
    c.part(
        "file_reps",
        """select *, case prefix when 'JC' then 'Robin North' when 'AK' then 'Sam East' when 'AG' then 'Kim South'
                          when 'CF' then 'Lou West' else 'Unknown' end as salesperson from files_seen""",
    )
    c.part(
        "import_rows",
        """select i.file, i.row_no, i.pass_no, i.size_pos, coalesce(r.salesperson, '') as salesperson,
                  case when s.customer is null then '' else 'Wholesale' end as sales_team, coalesce(s.customer, '') as name,
                  coalesce(m.id, '') as id, i.sku, i.qty as quantity, i.ext_id as external_id,
                  case when s.customer is null then '' else 'SURFJAN26' end as tags,
                  case when s.customer is null then '' else concat_ws(' | ',
                       concat('SHIP DATE: ', strftime(coalesce(s.ship_on, timestamp '2001-08-02'), '%m/%d/%Y')),
                       case when m.id <> '' then concat('CUSTOMER MATCH: (', s.customer, ' --> ', m.id, ') ', replace(replace(m.match_info, '[', ''), ']', ''))
                            else concat('CUSTOMER MATCH: (', s.customer, ') No match') end,
                       n.notes) end as rep_notes
           from (select *, case when start_row is not null
                           then row_number() over (partition by file, start_row order by row_no, pass_no, size_pos) end as nth
                 from found_items where sku is not null) i
           left join sheet_starts s on i.file = s.file and i.start_row = s.start_row and i.nth = 1
           left join file_reps r on i.file = r.file and s.customer is not null
           left join contact_results m on s.customer = m.customer
           left join notes_by_order n on i.file = n.file and i.start_row = n.start_row and i.nth = 1""",
    )

    # -- queries --------------------------------------------------------------
    c.add(
        "preprocess_strings",
        lambda t: preprocess_strings(
            t.master_rows.select(
                F.col("sku").alias(" SKU "),
                F.col("sku_parent").alias("SKU (Parent)"),
                F.col("size_abbreviation").alias("Size Abbreviation "),
                "collection",
                "season",
            )
        ).toDF("sku", "sku_parent", "size_abbreviation", "collection", "season"),
        """select upper(trim(sku)) as sku, upper(trim(sku_parent)) as sku_parent, upper(trim(size_abbreviation)) as size_abbreviation,
                  trim(collection) as collection, trim(season) as season from master_rows""",
    )
    c.add(
        "normalize_name",
        lambda t: t.contacts.select("row_no", match_name(F.col("name")).alias("normalized")),
        f"select row_no, {norm('name')} as normalized from contacts",
    )
    c.add(
        "variant_export_dedup",
        lambda t: o.variant_export_dedup(t.variant_export),
        "select * from export_ids",
    )
    c.add("master_ext_id", master, f"select {MASTER_COLUMNS} from master_ids")
    c.add("master_filtered", filtered, f"select {MASTER_COLUMNS} from master_kept")
    c.add(
        "master_unique",
        lambda t: o.master_unique(filtered(t)),
        f"select {MASTER_COLUMNS} from master_one",
    )
    c.add(
        "master_duplicates",
        lambda t: o.master_duplicates(master(t)),
        f"""select {MASTER_COLUMNS} from (
              select *, count(*) over (partition by sku_parent, size_abbreviation) as n from master_ids) d where n > 1""",
    )
    keys_left = lambda t: t.master_rows.select(upper_key(F.col("sku")).alias("sku"))
    keys_right = lambda t: t.variant_export.select(
        upper_key(F.col("internal_reference")).alias("sku")
    )
    both = (
        "select upper(trim(sku)) as sku from master_rows {} select upper(trim(internal_reference)) as sku from variant_export"
    )
    c.add(
        "sku_intersect",
        lambda t: keys_in_both(keys_left(t), keys_right(t), "sku"),
        both.format("intersect"),
    )
    c.add(
        "sku_except",
        lambda t: keys_only_left(keys_left(t), keys_right(t), "sku"),
        both.format("except"),
    )
    c.add(
        "size_columns",
        lambda t: t.spark.createDataFrame(
            sorted(sizes(t).items()), "size_col string, size string"
        ),
        """select k.size_col, k.size from (values ('s', 'S'), ('m', 'M'), ('l', 'L'), ('osfm', 'OSFM')) k(size_col, size)
           where k.size = 'OSFM' or k.size in (select size_abbreviation from master_kept)""",
    )
    headed = ", ".join(f'{column} as "{header}"' for column, header in o.IMPORT_COLUMNS.items())
    c.add(
        "import_files",
        import_files,
        f"select file, {headed} from import_rows",
    )
    c.add(
        "sheet_folder_items",
        sheet_folder,
        """select 'Café ' || l_suppkey as customer, 'P' || l_partkey as parent, cast(u.size_pos as integer) as size_pos, u.size, u.qty
           from lineitem, lateral (values
                (0, 0, 'S', cast(trunc(l_quantity) as bigint)), (0, 1, 'M', cast(l_linenumber as bigint) - 1),
                (1, 0, 'M', cast(l_linenumber as bigint) - 1), (1, 1, 'S', cast(trunc(l_quantity) as bigint)), (1, 2, 'L', 1),
                (2, 0, 'XL', cast(trunc(l_quantity) as bigint))) u(kind, size_pos, size, qty)
           where u.kind = l_orderkey % 3 and u.qty <> 0""",
    )
    c.add("sheet_rep_code", lambda t: o.sheet_rep_code(t.order_sheet, REPS), "select * from file_reps")
    c.add(
        "unknown_rep_files",
        lambda t: o.unknown_rep_files(t.order_sheet, REPS),
        "select file, prefix from file_reps where salesperson = 'Unknown'",
    )
    c.add(
        "order_groups",
        groups,
        "select * from grouped_rows",
    )
    c.add(
        "order_starts",
        lambda t: o.order_starts(sheet(t), AS_OF),
        """select file, start_row, customer, raw_ship_date, strftime(coalesce(ship_on, timestamp '2001-08-02'), '%m/%d/%Y') as ship_date,
                  ship_on is null as defaulted from sheet_starts""",
    )
    c.add("order_notes", lambda t: o.order_notes(groups(t)), "select * from notes_by_order")
    c.add(
        "order_notes_in_parts",
        lambda t: o.order_notes(
            groups(t).withColumn("start_row", F.lit(0).cast("bigint")), max_bytes=4000, too_long="split"
        ),
        """select * from (with stretches as (
             select file, row_no // 4096 as stretch, cast(sum(strlen(rep_notes) + 5) as bigint) as bytes,
                    string_agg(rep_notes, ' --- ' order by row_no) as notes
             from grouped_rows where rep_notes <> '' and start_row is not null group by file, row_no // 4096
           ), placed as (
             select *, cast(coalesce(sum(bytes) over (partition by file order by stretch
                                     rows between unbounded preceding and 1 preceding), 0) // 4000 as bigint) as part
             from stretches
           )
           select file, cast(0 as bigint) as start_row, part, string_agg(notes, ' --- ' order by stretch) as notes
           from placed group by file, part) q""",
    )
    c.add("order_items", items, "select * from long_items")
    c.add("order_items_enriched", enriched, "select * from found_items where sku is not null")
    c.add(
        "order_items_unmatched",
        lambda t: o.order_items_unmatched(items(t), lookup(t)),
        "select distinct parent, size from found_items where sku is null",
    )
    c.add("contact_match", matches, "select * from contact_results")
    c.add(
        "contact_match_of_pieces",
        lambda t: o.contact_match(name_pieces(t), t.contacts),
        f"""select * from (with asked_pieces as (
              select distinct trim(piece) as customer, {norm('piece')} as normalized
              from (select substring(name, 1 + cast(row_no % 3 as int), 1 + cast(row_no % 13 as int)) as piece from contacts) x
              where trim(piece) <> ''
            ), found as (
              select a.customer, a.normalized, count(p.row_no) as hits, count(*) filter (where p.company) as companies,
                     arg_min(p.id, p.row_no) as first_id, arg_min(p.id, p.row_no) filter (where p.company) as company_id,
                     arg_min(p.id, p.name_length * 10000000000 + p.row_no) filter (where p.company) as short_id
              from asked_pieces a left join people p on contains(p.normalized, a.normalized) group by a.customer, a.normalized
            ), tiers as (
              select f.*, (select count(*) from people p where p.name = f.customer) as n_exact,
                     (select count(*) from people p where p.name = f.customer and p.company) as c_exact,
                     (select arg_min(id, row_no) from people p where p.name = f.customer) as exact_id,
                     (select arg_min(id, row_no) from people p where p.name = f.customer and p.company) as exact_company,
                     (select count(*) from people p where p.normalized = f.normalized) as n_same,
                     (select count(*) from people p where p.normalized = f.normalized and p.company) as c_same,
                     (select arg_min(id, row_no) from people p where p.normalized = f.normalized) as same_id,
                     (select arg_min(id, row_no) from people p where p.normalized = f.normalized and p.company) as same_company
              from found f
            )
            select customer,
                   case when n_exact > 0 then coalesce(exact_company, exact_id) when n_same > 0 then coalesce(same_company, same_id)
                        when hits = 1 then first_id when companies = 1 then company_id when companies > 1 then short_id
                        when hits > 1 then first_id else '' end as id,
                   case when c_exact > 0 then '[Exact match, company]' when n_exact > 0 then '[Exact match]'
                        when c_same > 0 then '[Normalized match, company]' when n_same > 0 then '[Normalized match]'
                        when hits = 1 then concat('[Contains match, ', case when companies = 1 then 'company' else 'individual' end, ']')
                        when companies = 1 then '[Contains match, company, 1 of many]'
                        when companies > 1 then concat('[Contains match, company, 1 of ', companies, ']')
                        when hits > 1 then concat('[Contains match, 1 of ', hits, ']') else '[No match]' end as match_info
            from tiers) q""",
    )
    c.add(
        "contact_tiers",
        lambda t: value_counts(
            matches(t).select(o.contact_tier(F.col("match_info")).alias("tier")), "tier"
        ),
        """select case when match_info like '%Exact%' then 'exact' when match_info like '%Normalized%' then 'normalized'
                       when match_info like '%Contains%' then 'contains' else 'none' end as tier, count(*) as row_count
           from contact_results group by 1""",
    )
    c.add("order_import", order_import, "select * from import_rows")
    c.add(
        "missing_ext_ids",
        lambda t: o.missing_ext_ids(enriched(t)),
        "select file, row_no, sku from found_items where ext_id = ''",
    )
    c.add(
        "defaulted_ship_dates",
        lambda t: o.defaulted_ship_dates(sheet(t), AS_OF),
        """select file, customer, case when trim(raw_ship_date) = '' then '(blank)' else trim(raw_ship_date) end as raw_ship_date
           from sheet_starts where ship_on is null""",
    )
    c.add(
        "ship_date_clean",
        lambda t: with_ship_date(
            t.raw_cells.select("cell_id", "ship_cell"), "ship_cell", AS_OF, "ship_date", "defaulted"
        ),
        f"""select cell_id, ship_cell, strftime(coalesce(d, timestamp '2001-08-02'), '%m/%d/%Y') as ship_date, d is null as defaulted
            from (select cell_id, ship_cell, {clean_ship('ship_cell')} as d from raw_cells) x""",
    )
    stats = " union all ".join(
        (
            "select 'email' as check_name, count(profile_id) as matched, count(*) as total from matched_customers",
            """select 'external id', count(*) filter (where sku in (select internal_reference from export_ids)), count(*)
               from (select distinct sku from master_ids) a""",
            "select 'collection', count(rate_of_sale_30d), count(*) from collection_metrics",
            "select 'contact', count(*) filter (where id <> ''), count(*) from contact_results",
        )
    )
    c.add(
        "match_stats",
        all_match_stats,
        f"select *, matched * 100.0e0 / total as match_pct from ({stats}) u",
        match_pct=7,
    )
