"""Sources, sinks and continuous operation: data is written to scratch space and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import report_checks
from checks.oracle_books import with_books
from checks.ingest_checks import _ACCOUNTING, _LIVE
from daybook.operators import calendar
from daybook.operators.reshape import explode_path
from daybook.plans import ingest, reports, sinks, sync
from daybook.plans import store as st
from daybook.plans.books import Books, conform, open_books
from daybook.plans.months import save_by_month
from daybook.schema import TABLES
from daybook.session import scratch
from checks import testbed_documents
from daybook.sources import delimited, scan, xml
from checks.testbed import Testbed, testbed
from daybook.streaming import continuous

FROM, TO = "1998-04-01", "1999-03-31"


def _delimited(spark, folder):
    """Vouchers written as tab-separated text with the null mark, then scanned."""
    path = scratch(spark, "tsv")
    vouchers = Testbed(spark, folder).vouchers().withColumns({
        "narration": F.concat(F.lit('"'), "narration", F.lit('" España')),
        "reference_date": F.when(F.col("is_order_voucher") == 1, F.col("date"))})
    conform(vouchers, "trn_voucher").write.csv(
        path, sep="\t", header=True, quote="", nullValue=delimited.NULL_MARK, emptyValue="")
    return delimited.read_table(spark, path, "trn_voucher").select(
        "guid", "date", "narration", "reference_number", "reference_date", "is_invoice")


def _xml(spark, folder):
    """Voucher documents written as an XML export, scanned and flattened."""
    path = scratch(spark, "xml")
    docs = testbed_documents.voucher_documents(spark, folder)
    xml.write_export(docs, path, "voucher")
    return ingest.flatten(xml.read_documents(spark, path, "voucher", names=["trn_accounting"]), "trn_accounting")


def _landed_once(spark, folder):
    """The same export parsed once and landed; the table is flattened from there."""
    path = scratch(spark, "xml")
    docs = testbed_documents.voucher_documents(spark, folder)
    xml.write_export(docs, f"{path}/export", "voucher")
    xml.land(spark, f"{path}/export", "voucher", f"{path}/landed")
    return ingest.flatten(xml.landed(spark, f"{path}/landed"), "trn_accounting")


def _quarantined(spark, folder):
    """Objects with an unclosed field go into quarantine and into the quality table, all others are read."""
    path = scratch(spark, "broken")
    guid, broken = F.col("guid"), F.col("k") % 50 == 0
    Testbed(spark, folder).orders().select(F.concat(
        F.lit("<VOUCHER><GUID>"), guid, F.when(broken, "</GUID><DATE>2020</VOUCHER>").otherwise("</GUID><DATE>20200401</DATE></VOUCHER>")
    ).alias("value")).write.text(f"{path}/export")
    counts = xml.land(spark, f"{path}/export", "voucher", f"{path}/landed")
    apart = xml.quarantine(spark, f"{path}/landed").select(F.lit("broken").alias("kind"), F.regexp_extract(xml.BROKEN, "<GUID>(.*?)<", 1).alias("guid"))
    return (xml.landed(spark, f"{path}/landed").select(F.lit("document").alias("kind"), "guid").unionByName(apart)
            .unionByName(ingest.landed_quality(spark, "voucher", counts).select(
                F.lit("quality").alias("kind"), F.concat_ws("-", "table", "present", "rejected").alias("guid"))))


def _sales_by_month(spark, folder):
    """Daily sales of the period from books stored by month: folders of other months are not read."""
    path, bed = scratch(spark, "by-month"), testbed(spark, folder)
    names = ["mst_group", "mst_ledger", "mst_vouchertype", "trn_voucher", "trn_accounting"]
    save_by_month(Books(spark, {n: bed[n] for n in names}), path)
    return reports.sales_daily(open_books(spark, path, names), report_checks.FROM, report_checks.TO)


def _csv_books(spark, folder):
    """Ledgers through the CSV sink into a bare set of tables, queried as a view."""
    path = scratch(spark, "csv")
    sinks.write_csv(Testbed(spark, folder).ledgers(), f"{path}/mst_ledger.csv")
    delimited.read_csv(spark, f"{path}/mst_ledger.csv", "mst_ledger").createOrReplaceTempView("csv_ledger")
    return spark.sql("SELECT guid, name, parent, is_revenue, opening_balance, gstn FROM csv_ledger")


def _halves(spark, folder):
    """How many tables each selection keeps, and the rows of one of them."""
    books = testbed(spark, folder)
    masters = scan.select_half(books, transactions=False)
    transactions = scan.select_half(books, masters=False)
    parts = [books[n].agg(F.count("*").alias("rows")).select(
        F.lit(half).alias("half"), F.lit(n).alias("table"), "rows")
        for half, chosen in (("master", masters), ("transaction", transactions)) for n in sorted(chosen)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _filters(spark, folder):
    docs = testbed_documents.voucher_documents(spark, folder)
    return scan.all_of(docs, [F.col("iscancelled") == "No", "isoptional = 'No'"]).select("guid", "date")


def _batches(spark, folder):
    docs = testbed_documents.voucher_documents(spark, folder)
    live = docs.where(ingest.document_filters(explode_path(docs, "voucher"), TABLES["trn_voucher"]))
    return calendar.batches(live.select(F.to_date("date", "yyyyMMdd").alias("date")), 5000)


def _companies(spark, folder):
    """Three companies' vouchers in one job, stored by company, read with partition pruning."""
    path = scratch(spark, "companies")
    orders = Testbed(spark, folder).orders()
    parts = {f"Company {i}": orders.where(F.col("o_custkey") % 3 == i).select("guid", "date", "amt")
             for i in range(3)}
    sinks.full_refresh(scan.companies(parts), path, ["company"])
    return spark.read.parquet(path).groupBy("company").agg(
        F.count("*").alias("vouchers"), F.sum("amt").cast("decimal(27,2)").alias("amount"))


def _aggregated(spark, folder):
    return scan.aggregated(
        Testbed(spark, folder).orders(), {"date": "date"},
        {"n": ("COUNT", "1"), "total": ("SUM", "amt"), "low": ("MIN", "amt"), "high": ("MAX", "amt"),
         "mean": ("AVG", "k")}).withColumn("total", F.col("total").cast("decimal(27,2)"))


def _computed(spark, folder):
    return scan.computed(Testbed(spark, folder).vouchers().select("guid", "date", "voucher_type"), {
        "label": "upper(voucher_type) || ' ' || guid", "fiscal_year": "year(add_months(date, -3))"})


def _refreshed(spark, folder):
    """Two loads of the same table: the second replaces the first."""
    path = scratch(spark, "refresh")
    bills = Testbed(spark, folder).bills()
    sinks.full_refresh(bills.where(F.col("billtype") == "New Ref"), path)
    sinks.full_refresh(bills, path)
    return spark.read.parquet(path).select("guid", "ledger", "name", "amount")


def _appended(spark, folder):
    """Two periods loaded one after the other."""
    path = scratch(spark, "append")
    vouchers = Testbed(spark, folder).vouchers().select("guid", "date", "voucher_type")
    for part in (scan.in_period(vouchers, end="1997-12-31"), scan.in_period(vouchers, start="1998-01-01")):
        sinks.append(part, path)
    return spark.read.parquet(path)


def _csv_sink(spark, folder):
    path = scratch(spark, "csv")
    vouchers = Testbed(spark, folder).vouchers().withColumns({
        "narration": F.concat(F.lit('say "'), "narration", F.lit('"\r\n\tend')),
        "reference_date": F.when(F.col("is_order_voucher") == 1, F.col("date"))})
    sinks.write_csv(vouchers, path)
    return delimited.read_csv(spark, path, "trn_voucher").select(
        "guid", "date", "narration", "reference_date", "is_invoice")


def _json_sink(spark, folder):
    path = scratch(spark, "json")
    vouchers = conform(Testbed(spark, folder).vouchers(), "trn_voucher")
    sinks.write_json(vouchers, path)
    return spark.read.schema(vouchers.schema).json(path).select(
        "guid", "date", "narration", "reference_date", "is_invoice")


def _load_counts(spark, folder):
    """Rows written per table, observed during the write."""
    books = testbed(spark, folder)
    chosen = {n: books[n] for n in ("mst_ledger", "trn_voucher", "trn_accounting", "trn_inventory")}
    rows = sinks.load(chosen, scratch(spark, "load"))
    return spark.createDataFrame(sorted(rows.items()), "table string, rows bigint")


def _run_state(spark, folder):
    path = scratch(spark, "config")
    vouchers = Testbed(spark, folder).vouchers()
    span = calendar.period(vouchers).first()
    last = Testbed(spark, folder).orders().agg(F.max("k")).first()[0]
    sinks.write_state(sinks.run_state(spark, "Testbed", *span, 0, last), path)
    return spark.read.parquet(path).where(F.col("name") != sinks.STATE_TIMESTAMP)


def _change_files(spark, folder, target):
    """Three landed files: all vouchers, an edit of some and an out-of-order repeat, deletions."""
    docs = testbed_documents.voucher_documents(spark, folder).withColumn(
        "alterid", F.col("alterid").cast("bigint"))
    n = Testbed(spark, folder).source("orders").agg(F.count("*").alias("n")).scalar()
    urgent = F.col("narration").endswith("1-URGENT")
    low = F.col("narration").endswith("2-HIGH")
    first = docs.withColumn("deleted", F.lit(False))
    edited = docs.where(urgent).withColumns({
        "alterid": F.col("alterid") + n, "narration": F.lit("edited"), "deleted": F.lit(False)})
    gone = docs.where(low).withColumns({"alterid": F.col("alterid") + 2 * n, "deleted": F.lit(True)})
    for part in (first, edited.unionByName(first.where(urgent)), gone):
        part.write.mode("append").parquet(target)
    return first.schema


def _streamed(table, columns, twice=False):
    def run(spark, folder):
        base = scratch(spark, "stream")
        schema = _change_files(spark, folder, f"{base}/landing")
        store = st.Store(spark, f"{base}/store", parts=1, by="year")
        for checkpoint in ("a", "b")[:2 if twice else 1]:  # a lost checkpoint delivers all again
            continuous.run(spark, f"{base}/landing", schema, store, f"{base}/{checkpoint}").awaitTermination()
        return store.books()[table].select(*columns)
    return run


def _redelivered(spark, folder):
    """A batch handed over twice is applied once."""
    base = scratch(spark, "again")
    docs = testbed_documents.voucher_documents(spark, folder).withColumns(
        {"alterid": F.col("alterid").cast("bigint"), "deleted": F.lit(False)})
    store = st.Store(spark, f"{base}/store", parts=1, by="year")
    for _ in range(2):
        continuous.apply_changes(store, docs, 0)
    return store.books()["trn_accounting"].select("guid", "ledger", "amount")


def _landed(spark, folder, *files):
    """Runs the stream once after each landed file; ``files`` are functions of the documents."""
    base = scratch(spark, "landed")
    docs = testbed_documents.voucher_documents(spark, folder).withColumns(
        {"alterid": F.col("alterid").cast("bigint"), "deleted": F.lit(False)})
    n = Testbed(spark, folder).source("orders").agg(F.count("*").alias("n")).scalar()
    store = st.Store(spark, f"{base}/store", parts=1, by="year")
    for i, (file, checkpoint) in enumerate(files):
        file(docs, n).write.parquet(f"{base}/{checkpoint}/landing/{i}")
        landing = f"{base}/{checkpoint}/landing/*"
        continuous.run(spark, landing, docs.schema, store, f"{base}/{checkpoint}/state").awaitTermination()
    return store


_NARRATED = ["guid", "alterid", "narration"]
_URGENT = "narration like '%1-URGENT'"


def _edit(docs, by, text):
    return docs.where(_URGENT).withColumns({"alterid": F.col("alterid") + by, "narration": F.lit(text)})


def _late_file(spark, folder):
    """A file that lands later with the lower numbers, of other vouchers."""
    upper, lower = (lambda d, n: d.where(F.col("alterid") > n / 2)), (lambda d, n: d.where(F.col("alterid") <= n / 2))
    return _landed(spark, folder, (upper, "a"), (lower, "a")).books()["trn_voucher"].select(*_NARRATED)


def _new_checkpoint(spark, folder):
    """New files under a new checkpoint, whose batch numbers start at 0 again."""
    return _landed(spark, folder, (lambda d, n: d, "a"), (lambda d, n: _edit(d, n, "one"), "a"),
                   (lambda d, n: _edit(d, 2 * n, "two"), "b")).books()["trn_voucher"].select(*_NARRATED)


def _older_repeat(spark, folder):
    """A deletion followed by an older change of the same vouchers, and by a newer one of some."""
    gone = lambda d, n: d.where(_URGENT).withColumns({"alterid": F.col("alterid") + 2 * n, "deleted": F.lit(True)})
    again = lambda d, n: _edit(d, 3 * n, "again").where("isinvoice = 'Yes'")
    return _landed(spark, folder, (lambda d, n: d, "a"), (gone, "a"), (lambda d, n: _edit(d, n, "older"), "a"),
                   (again, "a")).books()["trn_voucher"].select(*_NARRATED)


def _sync_between(spark, folder):
    """A sync run between two batches: what it removed does not come back with an older change."""
    store = _landed(spark, folder, (lambda d, n: d, "a"))
    docs = testbed_documents.voucher_documents(spark, folder).withColumns(
        {"alterid": F.col("alterid").cast("bigint"), "deleted": F.lit(False)})
    n = docs.count()
    source = store.books()["trn_voucher"].where(f"not {_URGENT}").select("guid", "alterid")
    sync.run(store, {"trn_voucher": stored(source, "source")}, Books(spark, {}), {"master": 0, "transaction": 2 * n})
    continuous.apply_changes(store, _edit(docs, n, "older"), 0, stream="b")
    continuous.apply_changes(store, _edit(docs, 3 * n, "newer").where("isinvoice = 'Yes'"), 1, stream="b")
    return store.books()["trn_voucher"].select(*_NARRATED)


def stored(df, label):
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _raw_export(spark, folder):
    """Groups written as a raw export: envelope, entities and character references, no header."""
    path = scratch(spark, "raw")
    c = Testbed(spark, folder).source("customer")
    line = F.concat_ws("\t", F.concat(F.lit("G"), "c_custkey"), F.concat("c_name", F.lit(" &amp; Sons&#4; &lt;"), "c_mktsegment", F.lit("&gt;")),
                       F.lit("<FLDBLANK></FLDBLANK>"), *[F.lit("")] * (len(TABLES["mst_group"].columns) - 3))
    c.select(F.lit("<ENVELOPE>").alias("value")).limit(1).unionByName(c.select(line.alias("value"))).coalesce(1).write.text(path)
    return delimited.read_export(spark, path, "mst_group").select("guid", "name", "parent")


QUERIES = {
    "w3_late_lower_numbers": _late_file,
    "w3_new_checkpoint": _new_checkpoint,
    "w3_deletion_then_older": _older_repeat,
    "w3_sync_between_batches": _sync_between,
    "t16_raw_export": _raw_export,
    "s1_delimited_scan": _delimited,
    "s2_xml_scan": _xml,
    "s2_xml_landed_once": _landed_once,
    "s5_sales_daily_by_month": _sales_by_month,
    "s17_quarantine": _quarantined,
    "s4_csv_reimport": _csv_books,
    "s5_period_scan": lambda spark, folder: scan.in_period(
        Testbed(spark, folder).vouchers(), FROM, TO).select("guid", "date"),
    "s6_period_detection": lambda spark, folder: calendar.period(Testbed(spark, folder).vouchers()),
    "s8_half_selection": _halves,
    "s9_source_filters": _filters,
    "s12_source_aggregates": _aggregated,
    "s13_computed_columns": _computed,
    "s14_date_batches": _batches,
    "s15_companies": _companies,
    "k2_full_refresh": _refreshed,
    "k3_append": _appended,
    "k7_csv_sink": _csv_sink,
    "k10_json_sink": _json_sink,
    "k12_load_row_counts": _load_counts,
    "k13_run_state": _run_state,
    "w1_stream_once_vouchers": _streamed("trn_voucher", ["guid", "alterid", "narration"]),
    "w4_stream_once_accounting": _streamed("trn_accounting", ["guid", "ledger", "amount"]),
    "w3_stream_redelivered_batch": _redelivered,
}

_ALL_VOUCHERS = """
      select guid, date, {n} as narration, case when m = 0 then date end as reference_date,
        (m in (3, 8, 9))::tinyint as is_invoice from ord"""
_STREAM = f"{_LIVE} and o_orderpriority <> '2-HIGH'"

_NARRATION = "select guid, {} as alterid, {} as narration"
_N = "(select count(*) from orders)"
_OWN = "'R&D ' || o_orderpriority"
_IS_URGENT = "o_orderpriority = '1-URGENT'"

ORACLE = {
    "w3_late_lower_numbers": with_books(f"{_NARRATION.format('k + 1', _OWN)} {_LIVE}"),
    "w3_new_checkpoint": with_books(_NARRATION.format(
        f"k + 1 + case when {_IS_URGENT} then 2 * {_N} else 0 end", f"case when {_IS_URGENT} then 'two' else {_OWN} end") + f" {_LIVE}"),
    "w3_deletion_then_older": with_books(_NARRATION.format(
        f"k + 1 + case when {_IS_URGENT} then 3 * {_N} else 0 end", f"case when {_IS_URGENT} then 'again' else {_OWN} end")
        + f" {_LIVE} and (not {_IS_URGENT} or m in (3, 8, 9))"),
    "w3_sync_between_batches": with_books(_NARRATION.format(
        f"k + 1 + case when {_IS_URGENT} then 3 * {_N} else 0 end", f"case when {_IS_URGENT} then 'newer' else {_OWN} end")
        + f" {_LIVE} and (not {_IS_URGENT} or m in (3, 8, 9))"),
    "t16_raw_export": """
      select 'G' || c_custkey as guid, c_name || ' & Sons <' || c_mktsegment || '>' as name, '' as parent from customer""",
    "s1_delimited_scan": with_books("""
      select guid, date, '"' || o_orderpriority || '" España' as narration, '' as reference_number,
        case when m = 0 then date end as reference_date, (m in (3, 8, 9))::tinyint as is_invoice from ord"""),
    "s2_xml_scan": with_books(_ACCOUNTING),
    "s2_xml_landed_once": with_books(_ACCOUNTING),
    "s5_sales_daily_by_month": report_checks.ORACLE["r12_sales_daily"],
    "s17_quarantine": with_books("""
      select if(k % 50 = 0, 'broken', 'document') as kind, guid from ord
      union all select 'quality', 'voucher-' || count(*) filter (k % 50 <> 0) || '-' || count(*) filter (k % 50 = 0) from ord"""),
    "s4_csv_reimport": with_books("""
      select guid, name, parent, is_revenue::tinyint as is_revenue,
        cast(opening_balance as decimal(17,2)) as opening_balance, gstn from mst_ledger"""),
    "s5_period_scan": with_books(f"select guid, date from ord where date between date '{FROM}' and date '{TO}'"),
    "s6_period_detection": with_books("select min(date) as period_from, max(date) as period_to from ord"),
    "s8_half_selection": with_books(" union all ".join(
        f"select '{h}' as half, '{t}' as \"table\", count(*) as rows from {t}" for h, ts in (
            ("master", ["mst_group", "mst_ledger", "mst_opening_batch_allocation",
                        "mst_opening_bill_allocation", "mst_stock_item", "mst_vouchertype",
                        "trn_closingstock_ledger"]),
            ("transaction", ["trn_accounting", "trn_bill", "trn_inventory", "trn_voucher"]))
        for t in ts)),
    "s9_source_filters": with_books(f"select guid, strftime(date, '%Y%m%d') as date {_LIVE}"),
    "s12_source_aggregates": with_books("""
      select date, count(*) as n, cast(sum(amt) as decimal(27,2)) as total, min(amt) as low, max(amt) as high,
        avg(k) as mean from ord group by date"""),
    "s13_computed_columns": with_books("""
      select guid, date, voucher_type, upper(voucher_type) || ' ' || guid as label,
        year(date - interval 3 month)::int as fiscal_year from ord"""),
    "s14_date_batches": with_books(f"""
      with recursive days as (
        select date, count(*) as n, row_number() over (order by date) as i from (select date {_LIVE}) group by date),
      fold(i, batch, n, day) as (
        select i, 1, n, date from days where i = 1
        union all
        select d.i, case when f.n + d.n > 5000 then f.batch + 1 else f.batch end,
          case when f.n + d.n > 5000 then d.n else f.n + d.n end, d.date
        from fold f join days d on d.i = f.i + 1)
      select batch, min(day) as date_from, max(day) as date_to, max(n) as rows from fold group by batch"""),
    "s15_companies": with_books("""
      select 'Company ' || (o_custkey % 3) as company, count(*) as vouchers,
        cast(sum(amt) as decimal(27,2)) as amount from ord group by 1"""),
    "k2_full_refresh": with_books("select guid, ledger, name, amount from trn_bill"),
    "k3_append": with_books("select guid, date, voucher_type from ord"),
    "k7_csv_sink": with_books(_ALL_VOUCHERS.format(n="""'say "' || o_orderpriority || '"  end'""")),
    "k10_json_sink": with_books(_ALL_VOUCHERS.format(n="o_orderpriority").replace(
        "case when m = 0 then date end", "cast(null as date)")),
    "k12_load_row_counts": with_books(" union all ".join(
        f"select '{t}' as \"table\", count(*) as rows from {t}"
        for t in ("mst_ledger", "trn_voucher", "trn_accounting", "trn_inventory"))),
    "k13_run_state": with_books("""
      select 'Company Name' as name, 'Testbed' as value
      union all select 'Period From', min(date)::varchar from ord
      union all select 'Period To', max(date)::varchar from ord
      union all select 'Last AlterID Master', '0'
      union all select 'Last AlterID Transaction', max(k)::varchar from ord"""),
    "w1_stream_once_vouchers": with_books(f"""
      select guid, k + 1 + case when o_orderpriority = '1-URGENT' then (select count(*) from orders) else 0 end
          as alterid,
        case when o_orderpriority = '1-URGENT' then 'edited' else 'R&D ' || o_orderpriority end as narration
      {_STREAM}"""),
    "w4_stream_once_accounting": with_books(
        f"select guid, ledger, amount from ({_ACCOUNTING} where o_orderpriority <> '2-HIGH')"),
    "w3_stream_redelivered_batch": with_books(f"select guid, ledger, amount from ({_ACCOUNTING})"),
}
