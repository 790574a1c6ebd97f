"""Text and XML inputs, sinks and definitions."""

import datetime as dt
from decimal import Decimal

import pytest

from daybook.plans import ingest, sinks
from daybook.schema import LINKS, TABLES, incremental_columns
from daybook.sources import delimited, xml

LEDGERS = """<ENVELOPE>
<LEDGER NAME="Acme &amp; Co" RESERVEDNAME="">
 <GUID TYPE="String">g1</GUID>
 <PARENT TYPE="String">Primary</PARENT>
 <OPENINGBALANCE TYPE="Amount">-5.00</OPENINGBALANCE>
 <ADDRESS.LIST TYPE="String">
  <ADDRESS>one</ADDRESS>
  <ADDRESS>दो</ADDRESS>
 </ADDRESS.LIST>
 <LEDGSTREGDETAILS.LIST><GSTIN>A1</GSTIN></LEDGSTREGDETAILS.LIST>
 <LEDGSTREGDETAILS.LIST><GSTIN>A2</GSTIN></LEDGSTREGDETAILS.LIST>
 <BILLCREDITPERIOD TYPE="Due Date">30 Days</BILLCREDITPERIOD>
 <BILLALLOCATIONS.LIST>
  <NAME TYPE="String">B1</NAME><BILLDATE TYPE="Date">20200401</BILLDATE>
  <OPENINGBALANCE TYPE="Amount">-3.1234</OPENINGBALANCE><BILLCREDITPERIOD>7 Days</BILLCREDITPERIOD>
 </BILLALLOCATIONS.LIST>
</LEDGER>
<LEDGER NAME="Payroll" RESERVEDNAME=""><GUID>g2</GUID><FORPAYROLL TYPE="Logical">Yes</FORPAYROLL>
 <PAYTYPE>Not Applicable</PAYTYPE></LEDGER>
</ENVELOPE>"""

VOUCHERS = """<ENVELOPE>
<VOUCHER>
 <GUID TYPE="String">v1</GUID><DATE TYPE="Date">20200401</DATE>
 <VOUCHERTYPENAME>My Sales</VOUCHERTYPENAME><ISCANCELLED TYPE="Logical">No</ISCANCELLED>
 <ALLLEDGERENTRIES.LIST>
  <LEDGERNAME>Acme</LEDGERNAME><ISDEEMEDPOSITIVE TYPE="Logical">Yes</ISDEEMEDPOSITIVE>
  <AMOUNT TYPE="Amount">-100.00</AMOUNT>
  <BILLALLOCATIONS.LIST><NAME>B1</NAME><AMOUNT TYPE="Amount">-60.00</AMOUNT></BILLALLOCATIONS.LIST>
  <BILLALLOCATIONS.LIST><NAME>B2</NAME><AMOUNT TYPE="Amount">-40.00</AMOUNT></BILLALLOCATIONS.LIST>
 </ALLLEDGERENTRIES.LIST>
 <ALLLEDGERENTRIES.LIST>
  <LEDGERNAME>Sales</LEDGERNAME><AMOUNT TYPE="Amount">100.00</AMOUNT>
 </ALLLEDGERENTRIES.LIST>
 <ALLINVENTORYENTRIES.LIST>
  <STOCKITEMNAME>Bolt</STOCKITEMNAME><ISDEEMEDPOSITIVE TYPE="Logical">No</ISDEEMEDPOSITIVE>
  <ACTUALQTY TYPE="Quantity"> 12 Nos</ACTUALQTY><RATE TYPE="Rate">8.3333/Nos</RATE>
  <BATCHALLOCATIONS.LIST><BATCHNAME>X</BATCHNAME><ACTUALQTY TYPE="Quantity"> 12 Nos</ACTUALQTY></BATCHALLOCATIONS.LIST>
 </ALLINVENTORYENTRIES.LIST>
</VOUCHER>
<VOUCHER><GUID>v2</GUID><DATE>20200402</DATE><ISCANCELLED>Yes</ISCANCELLED>
 <ALLLEDGERENTRIES.LIST><LEDGERNAME>Acme</LEDGERNAME><AMOUNT>-1</AMOUNT></ALLLEDGERENTRIES.LIST>
</VOUCHER>
<VOUCHER><GUID>v3</GUID><DATE></DATE><ISOPTIONAL>Yes</ISOPTIONAL></VOUCHER>
</ENVELOPE>"""


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16LE"])
def test_xml_masters(spark, tmp_path, encoding):
    (tmp_path / "a.xml").write_bytes(LEDGERS.encode(encoding))
    docs = xml.read_documents(spark, str(tmp_path / "a.xml"), "ledger", encoding)
    ledger = {r.guid: r for r in ingest.flatten(docs, "mst_ledger").collect()}
    acme = ledger["g1"]
    assert (acme.name, acme.parent, acme.mailing_address, acme.gstn) == ("Acme & Co", "", "one, दो", "A2")
    assert (acme.opening_balance, acme.bill_credit_period) == (Decimal("-5.00"), 30)
    bill = ingest.flatten(docs, "mst_opening_bill_allocation").collect()
    assert [tuple(b) for b in bill] == [
        ("Acme & Co", Decimal("-3.1234"), dt.date(2020, 4, 1), "B1", 7, 0)]
    payhead = ingest.flatten(docs, "mst_payhead").collect()
    assert [(p.guid, p.name, p.pay_type) for p in payhead] == [("g2", "Payroll", "")]


def test_xml_vouchers(spark, tmp_path):
    (tmp_path / "v.xml").write_text(VOUCHERS, encoding="utf-8")
    docs = xml.read_documents(spark, str(tmp_path / "v.xml"), "voucher")
    types = spark.createDataFrame([("t", "My Sales", "Sales", "Automatic")],
                                  "guid string, name string, parent string, numberingmethod string")
    books = ingest.ingest({"voucher": docs, "vouchertype": types})
    header = books.trn_voucher.collect()
    assert [(v.guid, v.is_accounting_voucher, v.is_order_voucher) for v in header] == [("v1", 1, 0)]
    assert [(a.ledger, a.amount) for a in books.trn_accounting.collect()] == [
        ("Acme", Decimal("-100.00")), ("Sales", Decimal("100.00"))]
    assert [(b.guid, b.ledger, b.name, b.amount) for b in books.trn_bill.collect()] == [
        ("v1", "Acme", "B1", Decimal("-60.00")), ("v1", "Acme", "B2", Decimal("-40.00"))]
    line = books.trn_inventory.first()
    assert (line.item, line.quantity, line.rate, line.order_duedate) == (
        "Bolt", Decimal("-12.0000"), Decimal("8.3333"), None)
    assert books.trn_batch.first().quantity == Decimal("-12.0000")
    assert books.trn_bank.count() == 0


def test_every_table_flattens_from_its_xml_schema(spark):
    """All definitions agree with the schema derived from them."""
    for name, table in TABLES.items():
        docs = spark.createDataFrame([], xml.document_schema(table.path.split(".")[0]))
        out = ingest.flatten(docs, name)
        assert out.columns == list(table.columns)
        assert [f.dataType for f in out.schema] == [f.dataType for f in table.schema], name
        full = ingest.flatten(docs, name, masters={})
        assert full.columns == [c for c, _ in incremental_columns(table)]


def test_delimited(spark, tmp_path):
    (tmp_path / "a.data").write_text(
        'guid\tledger\tamount\tamount_forex\tcurrency\r\ng1\tSay "hi" España\t-5.25\tx\tñ\r\ng2\t\tñ\t1\t$',
        encoding="utf-8")
    got = delimited.read_table(spark, str(tmp_path / "a.data"), "trn_accounting").collect()
    assert [tuple(r) for r in got] == [
        ("g1", 'Say "hi" España', Decimal("-5.25"), None, None),
        ("g2", "", None, Decimal("1.00"), "$")]


def test_delimited_dates(spark, tmp_path):
    (tmp_path / "a.data").write_text("item\tdate\trate\nP\tñ\t1.5\nQ\t2020-04-01\t2\nR\t\t3\n", encoding="utf-8")
    got = delimited.read_table(spark, str(tmp_path / "a.data"), "mst_stockitem_standard_cost").collect()
    assert [r.date for r in got] == [None, dt.date(2020, 4, 1), None]


def test_csv_round_trip(spark, tmp_path, rows):
    df = rows("trn_voucher", {"guid": "a", "narration": 'a"b\\ c,d\r\ne\tf', "date": None},
              {"guid": "b", "narration": "हिन्दी", "date": "2020-04-01"})
    sinks.write_csv(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert '"a""b\\ c,d e f"' in text and '"guid"' in text
    got = {r.guid: r for r in delimited.read_csv(spark, str(tmp_path / "out"), "trn_voucher").collect()}
    assert got["a"].narration == 'a"b\\ c,d e f' and got["a"].date is None
    assert got["b"].narration == "हिन्दी" and got["b"].date == dt.date(2020, 4, 1)


def test_csv_books(spark, tmp_path, rows):
    for name in ("mst_group", "trn_bill"):
        sinks.write_csv(rows(name, {"name": "x"}), str(tmp_path / f"{name}.csv"))
    books = delimited.open_csv(spark, str(tmp_path), views=False)
    assert len(books) == 33
    assert books.config.count() == 0 and books.config.columns == ["name", "value"]
    assert books.mst_group.count() == 1 and books.trn_bill.first().name == "x"


def test_json_keeps_nulls(spark, tmp_path, rows):
    sinks.write_json(rows("trn_closingstock_ledger", {"ledger": "s"}), str(tmp_path / "j"))
    text = "".join(p.read_text() for p in (tmp_path / "j").glob("*.json"))
    assert '"stock_date":null' in text


def test_relational_sink_options():
    """The writer's settings; no database is started here."""
    options = sinks.jdbc_options("jdbc:x", "trn_bill", connections=8, driver="d",
                                 properties={"user": "u"})
    assert options["batchsize"] == "1000" and options["numPartitions"] == "8"
    assert options["dbtable"] == "trn_bill" and options["user"] == "u" and options["driver"] == "d"


def test_bucketed_tables_join_without_shuffle(spark, folder, tmp_path):
    from daybook.plans.books import Books
    from daybook.plans.reports import accounting_effects
    from checks.testbed import testbed
    bed = testbed(spark, folder)
    books = Books(spark, {n: bed[n] for n in ("trn_voucher", "trn_accounting")})
    sinks.save_bucketed(books, str(tmp_path / "b"), buckets=4)
    try:
        stored = sinks.open_bucketed(spark, ["trn_voucher", "trn_accounting"])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        report = accounting_effects(stored)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert report.exceptAll(accounting_effects(books)).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in books:
            spark.sql(f"DROP TABLE {n}")


def test_schema_catalogue():
    assert len(TABLES) == 32 and sum(t.nature == "Primary" for t in TABLES.values()) == 14
    assert sum(link.renames for link in LINKS) == 38
    assert [c for c, _ in incremental_columns(TABLES["mst_group"])][:5] == [
        "guid", "alterid", "name", "parent", "_parent"]


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16-le"])
def test_broken_objects_are_kept_apart(spark, tmp_path, encoding):
    text = ("<ENVELOPE><LEDGER NAME='a'><GUID>1</GUID></LEDGER><LEDGER NAME='b'><GUID>2</LEDGER>"
            "<LEDGER NAME='c'><GUID>3</GUID></LEDGER></ENVELOPE>")
    (tmp_path / "b.xml").write_bytes(text.encode(encoding))
    name = "UTF-16LE" if encoding != "utf-8" else "UTF-8"
    if name == "UTF-8":
        counts = xml.land(spark, str(tmp_path / "b.xml"), "ledger", str(tmp_path / "landed"), name)
        assert counts == {"objects": 3, "broken": 1}
        assert [r[0] for r in xml.quarantine(spark, str(tmp_path / "landed")).collect()] == ["<LEDGER NAME='b'><GUID>2</LEDGER>"]
        landed = xml.landed(spark, str(tmp_path / "landed"))
        assert sorted((r.name, r.guid) for r in landed.collect()) == [("a", "1"), ("c", "3")]
        plan = landed.select("guid")._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "FileScan text" not in plan and "from_xml" not in plan
    found = {(r.name, r.guid) for r in xml.read_documents(spark, str(tmp_path / "b.xml"), "ledger", name).collect()}
    assert found <= {("a", "1"), ("c", "3")} and ("a", "1") in found


def test_an_object_is_parsed_once(spark, tmp_path):
    """Filters and columns of a scan do not each parse the object again (F1)."""
    from daybook.plans.ingest import flatten

    target = tmp_path / "voucher.xml"
    target.write_text("<ENVELOPE>\n <VOUCHER>\n<GUID>a</GUID><ISCANCELLED>No</ISCANCELLED><ALLLEDGERENTRIES.LIST><LEDGERNAME>x"
                      "</LEDGERNAME><AMOUNT>1</AMOUNT></ALLLEDGERENTRIES.LIST></VOUCHER><VOUCHER  A='1'><GUID>b</GUID><ISCANCELLED>Yes"
                      "</ISCANCELLED><ALLLEDGERENTRIES.LIST><LEDGERNAME>y</LEDGERNAME></ALLLEDGERENTRIES.LIST></VOUCHER>\n"
                      "text <VOUCHERNUMBER/><VOUCHER ><GUID>c</GUID><NARRATION>n</VOUCHER></ENVELOPE>")
    for names in (None, ["trn_accounting"]):
        objects = xml.read_objects(spark, str(target), "voucher", names=names)
        assert sorted((r.guid or "", r[xml.BROKEN] is None) for r in objects.collect()) == [("", False), ("a", True), ("b", True)]
        flat = flatten(xml.read_documents(spark, str(target), "voucher", names=names), "trn_accounting")
        assert [(r.guid, r.ledger) for r in flat.collect()] == [("a", "x")]
        assert flat._jdf.queryExecution().executedPlan().toString().count("from_xml(") == 1


def _orders(spark, tmp_path, n):
    """Orders of ``n`` vouchers, and as many customers and suppliers as the testbed has to count."""
    orders = spark.range(n).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "cast(date'1996-01-01' + cast(id % 300 as int) as timestamp) as o_orderdate",
        "cast(id * 1.25 + 1 as decimal(15,2)) as o_totalprice", "'1-URGENT' as o_orderpriority", "'O' as o_orderstatus")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    for name in ("customer", "supplier"):
        spark.range(5).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("query", ["s2_xml_scan", "s2_xml_landed_once"])
def test_an_export_takes_little_room(spark, tmp_path, query, monkeypatch):
    """An export of the checks is some 1,900 bytes a voucher as text, which no disk holds for many vouchers (F1, F2)."""
    from checks import io_checks, testbed_documents

    n, folder = 2000, _orders(spark, tmp_path, 2000)
    monkeypatch.setattr(io_checks, "scratch", lambda session, label: str(tmp_path / label))
    monkeypatch.setattr(xml, "OBJECTS_A_FILE", 300, raising=False)
    got = io_checks.QUERIES[query](spark, folder)
    whole = ingest.flatten(testbed_documents.voucher_documents(spark, folder), "trn_accounting")
    assert got.count() == whole.count() > n
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()
    assert sum(p.stat().st_size for p in (tmp_path / "xml").rglob("*") if p.is_file()) < 300 * n


def test_an_export_is_written_in_files_of_bounded_size(spark, tmp_path):
    """A compressed file is read by one task, so a file holds so many objects at most, and nothing is lost between files."""
    schema = xml.document_schema("voucher")
    docs = spark.range(1050).selectExpr(
        "concat('v', id) as guid", "if(id % 3 = 0, null, 'R&D <1>') as narration", "'20200401' as date", "'No' as iscancelled",
        "array(named_struct('ledgername', 'a', 'amount', string(id)), named_struct('ledgername', 'हिन्दी', 'amount', '-1')) as allledgerentries")
    xml.write_export(docs.coalesce(1), str(tmp_path / "x"), "voucher", per_file=100)
    files = [p for p in (tmp_path / "x").iterdir() if p.name.startswith("part")]
    assert len(files) == 11 and all(p.name.endswith(".xml.gz") for p in files)
    read = xml.read_documents(spark, str(tmp_path / "x"), "voucher")
    assert read.schema.names == schema.names and read.count() == 1050
    assert sorted(map(tuple, ingest.flatten(read, "trn_accounting").select("guid", "ledger", "amount").collect())) == sorted(
        map(tuple, ingest.flatten(docs, "trn_accounting").select("guid", "ledger", "amount").collect()))
    assert read.where("narration = 'R&D <1>'").count() == 700 and read.where("narration is null").count() == 350
