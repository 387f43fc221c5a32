"""Pages without an id in the crawl."""

from tallymark.llm import queries


def test_pages_without_an_id_have_captures(spark, tmp_path):
    pages = [(None, "http://e.com/a", "x"), (3, "http://e.com/b", "y"), (None, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.QUERIES["op2_warc_revisits"](spark, str(tmp_path)).collect()
    lost = sorted((r.canonical_url or "", r.visit, r.verdict, r.response_id) for r in found if r.page_id is None)
    want = [("", 2), ("", 4), ("e.com/a", 2), ("e.com/a", 4)]
    assert lost == [(url, visit, "no_response", None) for url, visit in want]
    assert {r.visit for r in found if r.page_id == 3} == {2, 4}
