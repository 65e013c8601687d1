import json
import os

import pytest

from larkspur.sources.http import PagedRest

LOG = os.environ.get("LARKSPUR_TEST_FETCHES", "/tmp/larkspur-test-fetches")


def note(url):
    with open(LOG, "a") as f:
        f.write(url + "\n")


def chain(url):
    """Eleven pages by cursor, the last of which points back to the fourth."""
    note(url)
    name, at = url.split("//")[1].split("?")[0], int(url.split("cursor=")[1] or 0)
    return 200, json.dumps({"data": [{"id": f"{name}{at}-{i}"} for i in range(3)], "next": str(at + 1 if at < 10 else 3)}), {}


def flaky(url):
    """As chain, but the third page of b fails for as long as the file named in the log stays away."""
    if "//b" in url and url.endswith("=2") and not os.path.exists(LOG + ".mended"):
        return 403, "", {}
    return chain(url)


def numbered(url):
    note(url)
    page = int(url.split("page=")[1])
    return 200, json.dumps([{"id": page * 10 + i} for i in range(4 if page < 3 else 1)]), {}


@pytest.fixture
def run(spark, tmp_path):
    spark.dataSource.register(PagedRest)
    for f in (LOG, LOG + ".mended"):
        if os.path.exists(f):
            os.unlink(f)

    def once(**options):
        stream = spark.readStream.format("paged_rest").options(spool=f"file://{tmp_path}/spool", **options).load()
        out = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck")
        out.trigger(availableNow=True).start().awaitTermination(120)
        return sorted(json.loads(r["item"])["id"] for r in spark.read.schema("item string").parquet(f"{tmp_path}/out").collect())

    return once


def fetched():
    with open(LOG) as f:
        return f.read().split()


def test_restarts_repeat_no_page(run):
    """Each run is a new query from the same checkpoint; two listings, four pages a batch, the cycle ends both."""
    options = {"url": "http://a?cursor={cursor} http://b?cursor={cursor}", "items": "data", "cursor": "next", "pages_per_batch": "4", "fetch": "tests.test_paged_stream:chain"}
    sizes = [len(run(**options)) for _ in range(4)]
    assert sizes == [24, 48, 66, 66]
    got = run(**options)
    assert got == sorted(f"{x}{n}-{i}" for x in "ab" for n in range(11) for i in range(3))
    assert len(fetched()) == len(set(fetched())) == 22


def test_a_failed_fetch_goes_on_where_it_stopped(run):
    """The pages fetched before the failure are neither asked for again nor lost."""
    options = {"url": "http://a?cursor={cursor} http://b?cursor={cursor}", "items": "data", "cursor": "next", "pages_per_batch": "5", "fetch": "tests.test_paged_stream:flaky"}
    with pytest.raises(Exception, match="403"):
        run(**options)
    open(LOG + ".mended", "w").close()
    assert len(run(**options)) == 30 and len(run(**options)) == 60 and len(run(**options)) == 66
    assert len(fetched()) == len(set(fetched())) == 22


def test_numbered_pages_end_at_a_short_one(run):
    options = {"url": "http://x?page={page}", "page_size": "4", "pages_per_batch": "2", "fetch": "tests.test_paged_stream:numbered"}
    assert run(**options) == [10, 11, 12, 13, 20, 21, 22, 23]
    assert run(**options) == [10, 11, 12, 13, 20, 21, 22, 23, 30] and len(run(**options)) == 9
    assert len(fetched()) == 3


def test_a_spool_is_needed(spark):
    spark.dataSource.register(PagedRest)
    with pytest.raises(Exception, match="spool"):
        spark.readStream.format("paged_rest").option("url", "http://x?page={page}").load().writeStream.format("noop").start().awaitTermination(60)
