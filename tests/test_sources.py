"""Workbooks on disk, landing streams, and stored web responses."""

import io
import zipfile
from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterlake.catalog.books import NS, PKG, REL, encode_workbook
from rosterlake.operators import reshape
from rosterlake.plans import reports as R
from rosterlake.plans.vacancies import (
    API_COLUMNS, WEB_CARDS, WEB_COUNTER, WEB_PAGER, WEB_REGIONS, api_vacancies, new_vacancies, web_frontier,
    web_vacancies,
)
from rosterlake.sources import workbook
from rosterlake.sources.landing import landed_files, route
from rosterlake.sources.web import html_cards, html_links, json_tree_ids, page_count
from rosterlake.sources.workbook import CHUNK_ROWS, decode_workbooks, landing_status, sheet_rows, trim_sheet
from rosterlake.streaming.ingest import append_new, workbook_stream

SHEET = """<worksheet xmlns="{ns}"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>1</v></c><c r="E1" s="1"><v>44713</v></c></row>
<row r="2"><c r="A2"><v>12</v></c><c r="B2"><v>0.1</v></c><c r="C2" s="1"><v>44713.5</v></c><c r="D2" t="b"><v>1</v></c></row>
<row r="4"><c r="A4" t="e"><v>#N/A</v></c><c r="B4" t="str"><f>A1</f><v>n/a</v></c><c r="C4" s="2"><v>44714</v></c><c r="E4"><v>1E3</v></c></row>
<row r="5"><c r="A5"/></row>
</sheetData></worksheet>"""


def shared_string_book() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{REL}"><sheets><sheet name="a" sheetId="1" r:id="x"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PKG}"><Relationship Id="x" Target="/xl/worksheets/one.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{NS}"><si><t>ТК</t></si><si><r><t>Да</t></r><r><t>та</t></r><rPh><t>x</t></rPh></si></sst>')
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{NS}"><numFmts><numFmt numFmtId="164" formatCode="dd/mm/yy"/></numFmts>'
            '<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        )
        book.writestr("xl/worksheets/one.xml", SHEET.format(ns=NS))
    return out.getvalue()


def test_cells_headers_and_empty_rows(spark):
    files = spark.createDataFrame([("a.xlsx", bytearray(shared_string_book()))], "file string, content binary")
    chunks = decode_workbooks(files).collect()
    assert len(chunks) == 1
    assert chunks[0].headers == ["ТК", "Дата", "Unnamed: 2", "Дата.1", "2022-06-01 00:00:00"]
    assert chunks[0].rows == [
        ["12", "0.1", "2022-06-01 12:00:00", "True", None],
        [None] * 5,
        [None, None, "2022-06-02 00:00:00", None, "1000"],
    ]


def test_unreadable_files_give_a_status_and_no_rows(spark):
    damaged = bytearray(encode_workbook([(["a"], [[str(i * 7919)] for i in range(5000)])], {}))
    damaged[len(damaged) // 2] ^= 0xFF
    files = spark.createDataFrame(
        [("a.png", bytearray(b"\x89PNG")), ("b.zip", bytearray(b"PK\x05\x06" + bytes(18))), ("c.xlsx", damaged)],
        "file string, content binary",
    )
    chunks = decode_workbooks(files)
    assert chunks.filter("sheet IS NOT NULL OR size(rows) > 0").count() == 0
    status = {r.file: r for r in landing_status(chunks).collect()}
    assert set(status) == {"a.png", "b.zip", "c.xlsx"}
    assert all(r.status == "unreadable" and r.error and r.rows == 0 for r in status.values())


def book_of(sheet: str) -> bytearray:
    """The book above with another sheet."""
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as out, zipfile.ZipFile(io.BytesIO(shared_string_book())) as source:
        for name in source.namelist():
            out.writestr(name, sheet if name.endswith("one.xml") else source.read(name))
    return bytearray(book.getvalue())


def test_a_file_counts_whole_or_not_at_all(spark):
    head = f'<worksheet xmlns="{NS}"><sheetData><row><c><v>1</v></c></row>'
    many = "".join(f'<row r="{i}"><c><v>{i}</v></c></row>' for i in range(2, 3000))
    files = spark.createDataFrame([
        ("whole.xlsx", book_of(head + many + "</sheetData></worksheet>")),
        ("bad cell.xlsx", book_of(head + many + '<row r="3000"><c t="s"><v>x</v></c></row></sheetData></worksheet>')),
        ("stops.xlsx", book_of(head + many)),
        ("no day.xlsx", book_of(head + '<row><c s="1"><v>9999999999</v></c></row></sheetData></worksheet>')),
    ], "file string, content binary")
    status = {r.file: (r.status, r.rows) for r in landing_status(decode_workbooks(files)).collect()}
    assert status == {"whole.xlsx": ("read", 2998), "bad cell.xlsx": ("unreadable", 0), "stops.xlsx": ("unreadable", 0),
                      "no day.xlsx": ("unreadable", 0)}


def test_long_integers_stay_exact(spark):
    sheet = f"""<worksheet xmlns="{NS}"><sheetData><row><c t="str"><v>id</v></c></row>
    <row><c><v>1234567890123456</v></c></row><row><c><v>12345678901234567890</v></c></row>
    <row><c><v>-98765432109876543</v></c></row><row><c><v>1E3</v></c></row></sheetData></worksheet>"""
    files = spark.createDataFrame([("a.xlsx", book_of(sheet))], "file string, content binary")
    assert [r[0] for r in decode_workbooks(files).first().rows] == [
        "1234567890123456", "12345678901234567890", "-98765432109876543", "1000"]


def test_pager_labels_may_be_nested_and_quoted_either_way(spark):
    html = """<span class='count-x'>5&nbsp;000</span><span class="pager-a"><b>7</b></span>
    <span data-x='1' class='pager-b'><span>12</span></span><a class="x" href='/one'>One</a><a href="/two"><i>Two</i></a>"""
    pages = spark.createDataFrame([(1, html)], "id int, html string")
    assert pages.select(page_count(F.col("html"), "pager", "count")).first()[0] == 12
    assert [(r.href, r.label) for r in html_links(pages, "html", ["id"]).collect()] == [("/one", "One"), ("/two", "Two")]


def test_prefixed_markup_and_sparse_cells(spark):
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as out, zipfile.ZipFile(io.BytesIO(shared_string_book())) as source:
        for name in source.namelist():
            text = source.read(name).decode()
            if name.endswith("one.xml"):
                text = f"""<x:worksheet xmlns:x="{NS}"><x:sheetData><x:row><x:c><x:v>1</x:v></x:c><x:c r="AA1" t="inlineStr">
                <x:is><x:r><x:t>Го</x:t></x:r><x:r><x:t>род</x:t></x:r></x:is></x:c></x:row></x:sheetData></x:worksheet>"""
            out.writestr(name, text)
    files = spark.createDataFrame([("a.xlsx", bytearray(book.getvalue()))], "file string, content binary")
    headers = decode_workbooks(files).first().headers
    assert (len(headers), headers[0], headers[1], headers[26]) == (27, "1", "Unnamed: 1", "Город")


def test_large_sheet_is_chunked_and_trimmed(spark, tmp_path):
    n = 2 * CHUNK_ROWS + 5
    sheet = (["key", "day"], [[str(i), "2022-05-01T00:00:00"] for i in range(1, n + 1)])
    (tmp_path / "20.2022-05-01.a@b.big.xlsx").write_bytes(encode_workbook([sheet], {"key": "number", "day": "date"}))
    (tmp_path / "one.xlsx").write_bytes(encode_workbook([(["key"], [["1"]])], {}))
    chunks = decode_workbooks(landed_files(spark, str(tmp_path), "*.xlsx"))
    found = sheet_rows(chunks).orderBy("file", "row_no").collect()
    assert [(r.row_no, r.cells[0]) for r in found if r.file.endswith("big.xlsx")] == [(i, str(i)) for i in range(1, n + 1)]
    trimmed = sheet_rows(trim_sheet(chunks)).collect()
    assert sorted((r.row_no, int(r.cells[0])) for r in trimmed) == [(i, i) for i in range(2, n)]


def test_workbook_stream_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def deliver(name, rows):
        (landing / name).write_bytes(encode_workbook([(list(R.REVENUE_HEADER), rows), (["x"], [["y"]])], {}))

    def ingest():
        append_new(workbook_stream(spark, str(landing), "*.xlsx"), f"{tmp_path}/table", f"{tmp_path}/checkpoint")
        return spark.read.parquet(f"{tmp_path}/table")

    deliver("one.xlsx", [["1"] * 8, ["2"] * 8])
    (landing / "readme.txt").write_text("no workbook")
    assert sheet_rows(ingest()).count() == 3
    assert sheet_rows(ingest()).count() == 3
    deliver("two.xlsx", [["3"] * 8])
    after = ingest()
    assert sorted(r.cells[0] for r in sheet_rows(after.filter("sheet = 0")).collect()) == ["1", "2", "3"]
    kinds = {(r.file, r.sheet): r.kind for r in route(after, R.SIGNATURES, "headers").collect()}
    assert kinds == {("one.xlsx", 0): "revenues", ("one.xlsx", 1): None, ("two.xlsx", 0): "revenues", ("two.xlsx", 1): None}


@pytest.mark.parametrize(
    "headers, kind",
    [
        (R.REVENUE_HEADER, "revenues"), (R.REVENUE_HEADER[:-1], None), ((*R.REVENUE_HEADER, "x"), None),
        ((*R.PICKER_HEADER, "x"), "pickers"), (R.PICKER_HEADER[:27], None), (R.COURIER_HEADER, "couriers"),
        (("ТК", "Тип ресурса", "Доп потребность", "Ночь"), "requests"), (("ТК", "Тип ресурса", "Ночь"), None),
        ((), None),
    ],
)
def test_route(spark, headers, kind):
    frame = spark.createDataFrame([(list(headers),)], "headers array<string>")
    assert route(frame, R.SIGNATURES, "headers").first().kind == kind


def test_dated_columns_skip_names_and_totals(spark, rows):
    frame = spark.createDataFrame(
        [(["a", "01.05.22", "Итого", "2022-05-02 00:00:00"], ["n", "3", "9", "x"])], "headers array<string>, cells array<string>"
    )
    wide = frame.withColumn("days", reshape.dated_columns(F.col("headers"), R.DATES))
    out = reshape.unpivot_cells(wide, [], "day", "v")
    assert rows(out) == [(date(2022, 5, 1), 3.0), (date(2022, 5, 2), None)]


CARD = """<html><script>var x = '<div class="iva-item-body-1"><h3>no</h3></div>';</script>
<!-- <div class="iva-item-body-2"><h3>no</h3></div> -->
<div class="iva-item-body-3"><div><A HREF='/v/1?a=1&amp;b=2'><h3>Курьер <b>на&nbsp;авто</b></h3></A><br></div>
<meta itemprop="priceCurrency" content="RUB"><meta content=50000 itemprop=price>
<div class="x iva-item-description-9"><div>Лучшая</div> &laquo;работа&raquo;</div></div>
<div class="iva-item-description-9">footer</div><span data-marker="item-link">not in a card</span>
<div class="iva-item-body-4"><a href="/v/2?a=1&copy=2"><h3>Повар &amp кассир &</h3></a><meta itemprop="price" content="1"/>
<span data-marker="item-link">ООО &#171;Ромашка&#187;</span></div></html>"""


def test_html_cards(spark):
    pages = spark.createDataFrame([(1, CARD), (2, "<html></html>"), (3, None)], "region int, html string")
    found = html_cards(pages, "html", ["region"], WEB_CARDS).orderBy("card_no").collect()
    assert [tuple(r) for r in found] == [
        (1, 0, "/v/1?a=1&b=2", "Курьер на\xa0авто", "Лучшая «работа»", "50000", None),
        (1, 1, "/v/2?a=1&copy=2", "Повар &amp кассир &", None, "1", "ООО «Ромашка»"),
    ]
    vacancies = web_vacancies(pages).orderBy("vacancy_id").collect()
    assert [(v.vacancy_name, v.employer_name, v.description) for v in vacancies] == [
        ("курьер на\xa0авто", "", "Лучшая «работа»"), ("повар &amp кассир &", "ООО «Ромашка»", ""),
    ]


def test_html_links(spark, rows):
    pages = spark.createDataFrame([(1, '<a class="x" href="/a">A &amp; <b>B</b></a><a href="/b"></a>')], "id int, html string")
    assert rows(html_links(pages, "html", ["id"])) == [(1, 0, "/a", "A & B"), (1, 1, "/b", "")]


def pager(*labels, shown="5 000"):
    spans = "".join(f'<span class="{WEB_PAGER}-x">{label}</span>' for label in labels)
    return f'<span class="{WEB_COUNTER}-y">{shown}</span>{spans}'


@pytest.mark.parametrize(
    "html, pages",
    [
        ("<p>none</p>", 0), (pager("1", "...", " 7 ", "след."), 7), (pager("..."), 0),
        (pager("1", "100"), 100), (pager("1", "100", shown="3\xa0999"), 0), (pager("1", "100", shown="4&nbsp;000"), 100),
        (pager("99", shown="1"), 99),
    ],
)
def test_page_count(spark, html, pages):
    frame = spark.createDataFrame([(html,)], "html string")
    assert frame.select(page_count(F.col("html"), WEB_PAGER, WEB_COUNTER).alias("n")).first().n == pages


def test_area_ids_of_the_first_country(spark):
    tree = '[{"id":"113","areas":[{"id":"1","areas":[]},{"id":"22"}]},{"id":"5","areas":[{"id":"9"}]}]'
    frame = spark.createDataFrame([(tree,), ("broken",)], "body string")
    assert sorted(r.area_id for r in json_tree_ids(frame, "body").collect()) == [1, 22]


def test_api_vacancies(spark):
    body = """{"items":[{"id":"7","name":"Водитель-Курьер","area":{"id":"1"},"employer":{"name":"A"},
    "salary":{"from":null,"to":50,"gross":null},"published_at":"2022-05-11T12:00:00+0300","type":{"id":"open"},
    "snippet":{"requirement":null}}], "pages": 1}"""
    frame = spark.createDataFrame([(body,), (body,), ("{}",)], "body string")
    found = api_vacancies(frame)
    assert [tuple(r) for r in found.collect()] == [
        ("7", "водитель-курьер", 1, 1, None, "A", None, 50, False, datetime(2022, 5, 11, 9), "open", "")
    ]
    # as with SQL equality a row holding nulls is new on every run
    assert new_vacancies(found, found, API_COLUMNS).count() == 1
    assert new_vacancies(found, found, API_COLUMNS, null_safe=True).count() == 0


def test_web_frontier_holds_every_region_and_search(spark):
    regions = spark.createDataFrame(list(WEB_REGIONS.items()), "region_name string, region_id int")
    links = web_frontier(regions, "https://site.example/").collect()
    assert len(links) == 4 * 84
    assert ("https://site.example/pskov/vakansii/tag/peshij-kurer", "") in {(r.link, r.query) for r in links}


def test_workers_get_few_files_at_a_time(spark, monkeypatch):
    """Neither many nor large files make a batch, and what is read waits as Arrow."""
    seen = []
    monkeypatch.setattr(workbook, "_chunks", lambda file, content: seen.append(len(content)) or iter([(file, 0, ["a"], ["a"], 1, True, [["x"], [None]], None)]))
    batch = pa.RecordBatch.from_pydict({"file": ["a", "b"], "content": [b"1", b"22"]})
    out = workbook._decode(iter([batch]))
    first = next(out)
    assert seen == [1]  # the second file is not touched before the first is handed on
    assert isinstance(first, pa.RecordBatch) and first.to_pylist()[0]["rows"] == [["x"], [None]]
    large = spark.range(40, numPartitions=1).selectExpr("CAST(id AS STRING) AS file", "CAST(repeat('x', 1048576) AS BINARY) AS content")

    decode_workbooks(large)
    sizes = large.mapInArrow(lambda found: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in found), "n bigint").collect()
    assert sum(r.n for r in sizes) == 40 and max(r.n for r in sizes) <= 9
