"""Archives: a task with more rows than fit into one archive writes them all."""

from daymart.llm import warc


def test_rows_behind_a_full_archive_are_written(spark):
    pages = spark.createDataFrame([(k, f"http://a/{k}", f"<p>{k % 700} " + "x" * 1200) for k in range(900)],
                                  "page_id long, url string, html string").coalesce(1)
    manifest = warc.write(pages, limit=100_000)
    assert manifest.count() > 4 and manifest.groupBy().sum("n_records").first()[0] == 900
    back = {r.page_id: r for r in warc.read(manifest).collect()}
    assert sorted(back) == list(range(900))
    assert {k for k, r in back.items() if r.record_type == "revisit"} == set(range(200))
    assert all(back[k].refers_to == k + 700 for k in range(200))
