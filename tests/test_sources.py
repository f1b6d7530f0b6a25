"""Readers on small files."""

from foliant.sources import readers


def test_totals_with_four_columns(spark, tmp_path):
    (tmp_path / "five").mkdir()
    (tmp_path / "four").mkdir()
    (tmp_path / "five" / "t.tsv").write_text("session_label\tsession_year\tsession_type\ttotal_chapters\tcanonical_id\n1850\t1850\tregular\t146\tS1\n1851\tx\tregular\tunknown\tS2\n")
    (tmp_path / "four" / "t.tsv").write_text("session_label\tsession_year\tsession_type\ttotal_chapters\n1850\t1850\tregular\t146\n1863-64\t1863\textra\t12\n")
    got = lambda name: [tuple(r) for r in readers.totals(spark, str(tmp_path / name)).select("label", "year", "total", "id").orderBy("label").collect()]
    assert got("five") == [("1850", 1850, 146, "S1")]
    assert got("four") == [("1850", 1850, 146, "1850"), ("1863-64", 1863, 12, "1863-64")]


def test_volumes_are_found_by_their_folders(spark, tmp_path):
    for label, text in (("1850", '{"10": {"consensus_text": "b"}, "9": {"consensus_text": "a"}}'), ("1863-64", '{"0": {"consensus_text": ""}}')):
        (tmp_path / f"production-{label}" / "ocr_consensus").mkdir(parents=True)
        (tmp_path / f"production-{label}" / "ocr_consensus" / "page_ocr_results.json").write_text(text)
    rows = readers.pages(spark, f"{tmp_path}/*/ocr_consensus/page_ocr_results.json").orderBy("label", "page").collect()
    assert [(r.label, r.page, r.consensus_text) for r in rows] == [("1850", 9, "a"), ("1850", 10, "b"), ("1863-64", 0, "")]


def test_bills(spark):
    """Namespaces, sections within sections, CDATA, processing instructions, no content, and damaged files."""
    bill = """<?xml version="1.0"?><b:Bill xmlns:b="urn:x" xmlns:c="urn:y"><b:Part><c:BillSection action="amend"><c:Num> 1. </c:Num><c:Content><?ins start?>Old <i>text</i>
      here<b:BillSection action="repeal"><b:Num>1a</b:Num></b:BillSection> ends.</c:Content></c:BillSection></b:Part>
      <b:BillSection><b:Num>2</b:Num><b:Content><![CDATA[a < b & c]]></b:Content></b:BillSection><!-- <BillSection/> --></b:Bill>"""
    files = spark.createDataFrame([("a", bill), ("b", "<Bill><BillSection>"), ("c", None), ("d", "<Bill/>")], "file string, text string")
    got = [tuple(r)[:5] for r in readers.bill_actions(files).filter("error IS NULL").orderBy("file", "order").collect()]
    assert got == [("a", 1, "1.", "amend", "Old text here ends."), ("a", 2, "1a", "repeal", ""), ("a", 3, "2", "", "a < b & c")]
    wrong = readers.bill_actions(files).filter("error IS NOT NULL").collect()
    assert sorted(r.file for r in wrong) == ["b", "c"] and all(r.order is None for r in wrong)
