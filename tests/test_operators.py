import io
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import curves, knowledge, records, relational
from strataflow.sources import documents, html, las, tables
from strataflow.streaming import queue


def test_not_in_follows_nulls(spark):
    left = spark.createDataFrame([(1, 1), (2, 2), (3, None), (None, 4)], "a int, b int")
    for other in ([(1, 1)], [(1, 1), (None, 2)], [], [(None, None)]):
        right = spark.createDataFrame(other, "a int, b int")
        left.createOrReplaceTempView("l")
        right.createOrReplaceTempView("r")
        want = sorted(map(str, spark.sql("SELECT * FROM l WHERE (a, b) NOT IN (SELECT a, b FROM r)").collect()))
        assert sorted(map(str, relational.not_in_pairs(left, right, ["a", "b"]).collect())) == want


def test_sync(spark):
    source = spark.createDataFrame([(1, "a"), (2, "x"), (4, None)], "k int, v string")
    target = spark.createDataFrame([(1, "a", "own1"), (2, "b", "own2"), (3, "c", "own3")], "k int, v string, w string")
    assert sorted(map(tuple, relational.sync_changes(source, target, "k").collect())) == [(2, "update"), (3, "delete"), (4, "insert")]
    assert sorted(map(tuple, relational.synced(source, target, "k").collect())) == [(1, "a", "own1"), (2, "x", "own2"), (4, None, None)]


def test_curve_against_numpy(spark):
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(0, 5, 400), 2)
    df = spark.createDataFrame([(1, i, i, float(x)) for i, x in enumerate(v)], "series long, ts long, row long, value double")
    got = [r["gradient"] for r in curves.gradient(curves.numbered(df)).orderBy("i").collect()]
    assert np.allclose(got, np.gradient(v), atol=1e-5)
    row = curves.stats(df).first()
    assert np.allclose([row["median"], row["std"], row["p95"]], [np.median(v), v.std(), np.percentile(v, 95)], atol=1e-5)
    moving = {r["start"]: r["variance"] for r in curves.moving_variance(curves.numbered(df), 100, 50).collect()}
    assert sorted(moving) == list(range(0, 300, 50))
    assert all(abs(moving[s] - v[s : s + 100].var()) < 1e-3 for s in moving)
    spaced = [r["i"] for r in curves.spaced(spark.createDataFrame([(1, x) for x in (0, 10, 51, 60, 102, 103)], "series long, i long")).orderBy("i").collect()]
    assert spaced == [0, 51, 102]
    wave = spark.createDataFrame([(1, i, i, float(np.sin(2 * np.pi * i / 20))) for i in range(400)], "series long, ts long, row long, value double")
    best = curves.spectrum_top(curves.numbered(wave), 2).collect()
    assert sorted(round(r["frequency"], 9) for r in best) == [-0.05, 0.05]


def test_curves_do_not_depend_on_buckets(spark):
    rng = np.random.default_rng(2)
    rows = [(s, float(rng.integers(0, 60)), i, None if i % 17 == 0 else float(rng.normal() * 1e-5 + (1e15 if s == 2 else 0))) for s in (1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, "series long, ts double, row long, value double")
    want = {}
    for s in (1, 2):
        own = np.array([v for _, _, v in sorted((t, i, v) for k, t, i, v in rows if k == s and v is not None)])
        want[s] = own
    for width in (1.0, 7.0, 1e9):
        found = curves.numbered(df, width).collect()
        for s, own in want.items():
            assert [r["value"] for r in sorted((r for r in found if r["series"] == s), key=lambda r: r["i"])] == own.tolist() and {r["n"] for r in found if r["series"] == s} == {len(own)}
    slopes = curves.gradient(curves.numbered(df)).collect()
    for s, own in want.items():
        assert np.allclose([r["gradient"] for r in sorted((r for r in slopes if r["series"] == s), key=lambda r: r["i"])], np.gradient(own), atol=1e-9)
    small = {r["series"]: r for r in curves.stats(df).collect()}
    assert abs(small[1]["mean"] - want[1].mean()) < 1e-12 and small[1]["std"] > 1e-6 and abs(small[2]["mean"] - 1e15) < 10
    regimes = {r["series"]: (r["low"], r["high"], r["middle"]) for r in curves.regimes(df).collect()}
    q1, q3 = np.percentile(want[1], [25, 75])
    low, high = (want[1] < q1 - 0.5 * (q3 - q1)).sum(), (want[1] > q3 + 0.5 * (q3 - q1)).sum()
    assert regimes[1] == (low, high, len(want[1]) - low - high)


def test_spaced_peaks_equal_a_pass(spark):
    rng = np.random.default_rng(3)
    places = {s: sorted(set(rng.integers(0, 200_000, 3000).tolist())) for s in (1, 2)}
    want = set()
    for s, own in places.items():
        last = None
        for i in own:
            if last is None or i - last > 50:
                want.add((s, i))
                last = i
    df = spark.createDataFrame([(s, i) for s, own in places.items() for i in own], "series long, i long")
    assert {(r["series"], r["i"]) for r in curves.spaced(df).collect()} == want


def test_hierarchies_of_any_depth(spark):
    rows = [(i, i + 1) for i in range(100)] + [(100, None), (200, 201), (500, 999)] + [(201 + i, 201 + (i + 1) % 77) for i in range(77)]
    found = records.hierarchy_problems(spark.createDataFrame(rows, "k int, p int"), "k", "p").collect()
    assert {(r["key"], r["problem"]) for r in found} == {(500, "unknown_parent")} | {(201 + i, "cycle") for i in range(77)}


def test_graph_and_life_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    got = {r["node"]: r["depth"] for r in knowledge.breadth_first(edges, spark.createDataFrame([("a",)], "node string"), 8).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}
    changes = spark.createDataFrame([("CANDIDATE", "ACCEPTED"), ("SUPPORTED", "ACCEPTED")], "b string, a string")
    assert [tuple(r) for r in knowledge.invalid_transitions(changes, "b", "a").collect()] == [("CANDIDATE", "ACCEPTED")]


LAS = """~Version
VERS. 2.0 : version
~Well
NULL. -999.25 : null value
WELL. LMC-12 : well
~Curve
DEPT.M : 1 depth
HKLD.klb : 2 hook load
TAG. : 3 state
~A
1.0 10.5 on
2.0 -999.25 off
3.0 NaN on
"""


def test_las(spark, tmp_path):
    (tmp_path / "RIG9_LMC_28-07-2025_1.las").write_text(LAS)
    (tmp_path / "RIG9_bad_99-99-2025.LAS").write_bytes(LAS.replace("hook", "guiñ").encode("latin-1"))
    las.register(spark)
    heads = spark.read.format("las_header").load(str(tmp_path))
    assert heads.filter("section = 'C'").count() == 6 and heads.filter("sha256 is not null").count() == 0
    assert spark.read.format("las_header").option("hash", "true").load(str(tmp_path)).filter("sha256 is null").count() == 0
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.las").load(str(tmp_path))
    assert las.headers_of(files).count() * 2 == heads.count() and las.data_of(files).count() == 9
    wrapped = LAS.replace("~Well", "WRAP. YES : wrapped\nDLM. COMMA : comma\n~Well").replace("1.0 10.5 on\n", "1.0,\n10.5, on\n").replace("2.0 -999.25 off", "2.0,-999.25,off").replace("3.0 NaN on", "3.0,NaN,on")
    cells = list(las.data(wrapped.replace("1.0,\n", "1.0\n").splitlines()))
    assert [c[4] for c in cells if c[2] == "HKLD"] == [10.5, None, None] and cells[2][5] == "on"
    meta = las.file_metadata(heads.select("path").distinct()).collect()
    assert {r["rig"] for r in meta} == {"RIG9"} and sorted(str(r["file_date"]) for r in meta) == ["2025-07-28", "None"]
    rows = spark.read.format("las_data").load(str(tmp_path / "RIG9_LMC_28-07-2025_1.las"))
    got = [(r["row"], r["mnemonic"], r["value"], r["text"]) for r in rows.orderBy("row", "place").collect()]
    assert got[1] == (0, "HKLD", 10.5, None) and got[4] == (1, "HKLD", None, None) and got[7][2] is None and got[2] == (0, "TAG", None, "on")
    assert {r["total"] for r in las.curve_order(heads).collect()} == {3}
    assert "-999.25" in las.to_json(rows).first()["json"]


def test_html():
    page = "<title>T</title><p>a <b>b</b> c</p><p>one</p><script>x</script><img title='cap'><img src='i.png'><a href='/u'>l</a><dl><dt>ROP</dt><dd>rate</dd><dd>no term</dd></dl><table><caption>Cap</caption><tr><th>h</th><th>i</th></tr><tr><td> </td></tr><tr><td>1 <b>2</b></td><td>3</td></tr></table><h2>H</h2><li>item</li>"
    assert html.elements(page) == [
        ("title", "T", None, None, None), ("paragraph", "c", None, None, None), ("paragraph", "one", None, None, None), ("figure", "figure", "cap", None, None), ("figure", "i.png", None, None, None), ("link", "l", "/u", None, None),
        ("glossary", "ROP: rate", None, None, None), ("table_row", "h|i", "Cap", 1, 1), ("table_row", "1 2|3", "Cap", 1, 2), ("heading2", "H", None, None, None), ("paragraph", "item", None, None, None),
    ]
    assert html.elements("") == [("title", html.NO_TITLE, None, None, None)]


def test_documents(spark):
    text = "# A\ntext\nmore [l](u)\n\n[x](y)\n|h|i|\n|-|:-|\n|1|2|\n## B\n![](f)\n![g](f)\nGlossary:\nROP: rate: x\n- b\n\nend"
    kinds = [(k, t, a, n, r) for k, t, a, n, r in documents.markdown_blocks(text)]
    none = (None, None)
    assert kinds == [
        ("title", "A", None, *none), ("heading1", "A", None, *none), ("link", "l", "u", *none), ("paragraph", "text more [l](u)", None, *none), ("link", "x", "y", *none), ("table_row", "h|i", None, 1, 1), ("table_row", "1|2", None, 1, 3),
        ("heading2", "B", None, *none), ("figure", "figure_1", None, *none), ("figure", "g", None, *none), ("glossary", "ROP: rate: x", None, *none), ("paragraph", "end", None, *none),
    ]
    df = spark.createDataFrame([(1, "Title\n\n body \n\n\nlast"), (2, None), (3, "only")], "k int, t string")
    assert [(r["k"], r["kind"], r["text"]) for r in documents.paragraphs(df, "k", "t").orderBy("k", "place").collect()] == [(1, "title", "Title"), (1, "paragraph", "body"), (1, "paragraph", "last"), (3, "title", "only"), (3, "paragraph", "only")]
    formats = spark.createDataFrame([("a.MD",), ("b/c.pdf",), ("x.exe",)], "p string").select(documents.format_of(F.col("p")).alias("f"))
    assert [r["f"] for r in formats.collect()] == ["markdown", "pdf", None]


def _zip(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return out.getvalue()


def test_office_files(spark):
    w = "xmlns:w='http://schemas.openxmlformats.org/wordprocessingml/2006/main'"
    docx = _zip({
        "word/document.xml": f"<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val='H2'/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:t>See </w:t></w:r><w:r><w:t>table 1</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl></w:body></w:document>",
        "word/styles.xml": f"<w:styles {w}><w:style w:styleId='H2'><w:name w:val='heading 2'/></w:style></w:styles>",
    })
    s, r = "xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'", "xmlns:r='http://schemas.openxmlformats.org/officeDocument/2006/relationships'"
    xlsx = _zip({
        "xl/workbook.xml": f"<workbook {s} {r}><sheets><sheet name='One' r:id='rId1'/><sheet name='Two' r:id='rId2'/></sheets></workbook>",
        "xl/_rels/workbook.xml.rels": "<Relationships><Relationship Id='rId1' Target='worksheets/s1.xml'/><Relationship Id='rId2' Target='worksheets/s2.xml'/></Relationships>",
        "xl/sharedStrings.xml": f"<sst {s}><si><t>Tag</t></si><si><r><t>Va</t></r><r><t>lue</t></r></si></sst>",
        "xl/worksheets/s1.xml": f"<worksheet {s}><sheetData><row><c r='A1' t='s'><v>0</v></c><c r='C1' t='s'><v>1</v></c></row><row/><row><c r='A3'><v>7</v></c><c r='B3'><v>0.5</v></c><c r='D3' t='b'><v>1</v></c></row></sheetData></worksheet>",
        "xl/worksheets/s2.xml": f"<worksheet {s}><sheetData/></worksheet>",
    })
    files = [("d/my_doc.docx", docx), ("d/w.xlsx", xlsx), ("x.exe", b"1"), ("p.PDF", b"%PDF"), ("broken.docx", b"no zip"), ("n.txt", "T\n\nb".encode()), ("h.htm", b"<p>x</p>")]
    rows = {}
    for r in documents.parsed(spark.createDataFrame(files, "path string, content binary")).orderBy("path", "place").collect():
        rows.setdefault(r["path"], []).append((r["kind"], r["text"], r["table"], r["row"]))
    assert rows["d/my_doc.docx"] == [("title", "my doc", None, None), ("heading2", "Head", None, None), ("paragraph", "See table 1", None, None), ("reference", "See table 1", None, None), ("table_row", "a|", 1, 1)]
    assert rows["d/w.xlsx"] == [("title", "w", None, None), ("heading1", "One", None, None), ("table_caption", "Sheet One from file w.xlsx. Columns: Tag |  | Value | . Data rows: 1.", None, None), ("table_row", "Tag||Value|", 1, 1), ("table_row", "7|0.5||TRUE", 1, 2), ("heading1", "Two", None, None)]
    assert rows["x.exe"] == [("error", "unsupported_document_format: exe", None, None)] and rows["p.PDF"][0][1].startswith(("missing_pdf_dependency", "unreadable")) and rows["broken.docx"] == [("error", "unreadable: BadZipFile", None, None)]
    assert rows["n.txt"] == [("title", "T", None, None), ("paragraph", "b", None, None)] and rows["h.htm"][1][1] == "x"


def test_csv_in_and_out(spark, tmp_path):
    source = tmp_path / "wells.csv"
    source.write_text('Operator,Well Name,Contractor,Rig,Spud Date,Latest EDR\nA,"W, 1",C,R-1,2024-01-05,2024-06-01 07:00:00\nB,W2,,,bad,\n')
    rows = tables.well_list(spark, str(source), F.lit("2024-06-01 12:30:00").cast("timestamp")).orderBy("operator").collect()
    assert [(r["well_name"], str(r["spud_date"]), r["status"]) for r in rows] == [("W, 1", "2024-01-05", "online"), ("W2", "None", "offline")]
    df = spark.createDataFrame([("R", "x;y", None)], "Rig string, Operator string, z string")
    tables.save_csv(df.coalesce(1), str(tmp_path / "out"), ("Operator", "Well Name", "Rig"), separator=";", bom=True)
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert text == '\ufeffOperator;Well Name;Rig\n"x;y";;R\n'


def test_queue_is_idempotent(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).withColumnRenamed("id", "k").write.parquet(inbox)
    for check in ("c1", "c1", "c2"):  # the last run has lost its checkpoint
        queue.process_once(queue.pending_files(spark, inbox, "k long"), lambda b: b, "k", out, str(tmp_path / check)).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
    with_payload = spark.createDataFrame([(3, "a"), (9, "b")], "k long, v string")
    queue.append_once(with_payload, "k", str(tmp_path / "p"), ["v"])
    queue.append_once(with_payload, "k", str(tmp_path / "p"), ["v"])
    with pytest.raises(queue.ConflictError):
        queue.append_once(with_payload.withColumn("v", F.lit("c")), "k", str(tmp_path / "p"), ["v"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
