import base64
import gzip
import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from conftest import TEXTS
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from test_pairs import brute_jaccard
from test_texts import ITEMS, brute_contamination, brute_pii, check_packed
from textmark.llm import frames, jaccard, queries, warc
from textmark.settings import BATCH_BYTES

PAGES = [
    (1, "http://a/ b\r\nX: y", "<p>ą</p>"), (2, None, "<p>ą</p>"), (3, "http://c", None), (4, "http://d", ""),
    (5, "http://e", "x\r\n\r\ny\x00"), (None, "http://f", "<p>ą</p>"), (None, "http://g", "only"), (2, None, "<p>ą</p>"),
    (1, "http://a", "<p>ą</p>"), (7, "http://h", "z" * 300_000), (6, "http://h", "z" * 300_000),
]


def expected_pages(least=0):
    out = Counter()
    for page, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(same) if same and len([1 for _, _, h in PAGES if (h or "") == (html or "")]) > 1 else None
        again = len(data) >= least and first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[page, len(data), digest, "revisit" if again else "response", first if again else None] += 1
    return out


def pages(spark):
    schema = "page_id long, url string, html string, file string, digest string, offset long, first long"
    return spark.createDataFrame([(*p, "f", "d", 1, 2) for p in PAGES], schema).repartition(3)


def test_warc_round_trip_and_edges(spark, tables):
    found = queries.op4_warc(spark, tables(pages=pages(spark))).collect()
    assert Counter(tuple(x) for x in found) == expected_pages()
    archives = warc.new_folder(spark)
    index = warc.write(pages(spark), archives, least=9, file_bytes=400)
    back = warc.read(index, archives).collect()
    assert Counter((x["page_id"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"]) for x in back) == expected_pages(9)
    texts = Counter((p, h or "") for p, _, h in PAGES)
    for x in back:
        if x["payload"] is not None:
            assert texts[x["page_id"], bytes(x["payload"]).decode()]
    none = pages(spark).limit(0)
    assert warc.read(warc.write(none, warc.new_folder(spark)), archives).collect() == []


def test_index_rows_address_single_records(spark):
    archives = warc.new_folder(spark)
    index = warc.write(pages(spark), archives)
    for row in index.collect():
        with open(f"{archives.removeprefix('file://')}/{row['file']}", "rb") as source:
            source.seek(row["offset"])
            headers, size, payload = warc.parsed(gzip.decompress(source.read(row["length"])))
        assert headers["WARC-Payload-Digest"] == f"sha1:{row['payload_digest']}"
        assert headers["WARC-Type"] == row["record_type"]
        assert "\n" not in headers["WARC-Target-URI"] and (payload is None) == (row["record_type"] == "revisit")
    one = warc.read(index.where("page_id = 7"), archives).collect()
    assert len(one) == 1 and one[0]["refers_to"] == 6


def test_ranges_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 1), ("b", 101, 5), ("b", 106, 50)]
    found = list(warc.ranges(rows, gap=5, most=40))
    assert found == [("a", 0, 30, 0, 3), ("a", 100, 101, 3, 4), ("b", 101, 106, 4, 5), ("b", 106, 156, 5, 6)]
    assert list(warc.ranges([], 1, 1)) == []


def test_contract():
    numbers = sorted(int(n[2:].split("_")[0]) for n in contract.queries() if n.startswith("op") and n[2:3].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]


@pytest.fixture
def small(spark, edges, tables):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").unionByName(
        spark.sql("select cast(null as bigint) doc_id, 1 quality, null toxic union all select 5, null, 0")
    )
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = given.select(*[F.col(c) if c in given.columns else F.lit(None).cast(t).alias(c) for c, t in edges.dtypes])
    docs = more.unionByName(edges.withColumn("doc_id", F.col("doc_id") + 100_000))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return tables(documents=docs, labels=labels, benchmark=items)


def test_every_stage_against_plain_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, small)
        if name != "packing":
            assert docs.dtypes == before.dtypes
        rows = docs.collect()
        steps[name] = ([tuple(x) for x in before.select("doc_id", "text").collect()], rows)
        docs = spark.createDataFrame(rows, docs.schema)

    before, after = steps["near_duplicates"]
    groups = brute_jaccard(before)
    wanted = {k for k, _, c in groups if k is not None and k == c}
    assert sorted(x["doc_id"] for x in after if x["doc_id"] is not None) == sorted(wanted)
    assert sum(x["doc_id"] is None for x in after) == sum(k is None for k, _ in before)

    before, after = steps["decontamination"]
    dirty = brute_contamination(before, ITEMS)
    assert sorted((x["doc_id"] for x in after), key=repr) == sorted((x[0] for x in dirty if not x[-1]), key=repr)

    before, after = steps["pii"]
    assert len(before) == len(after)
    assert not any(brute_pii(x["text"]) for x in after)
    clean = {k: t for k, t in before if t is not None and not brute_pii(t)}
    assert all(x["text"] == clean[x["doc_id"]] for x in after if x["doc_id"] in clean)

    before, after = steps["packing"]
    check_packed(after, before)
    whole = corpus_pipeline.run(spark, small).drop("sequence_id", "offset").collect()
    assert Counter(map(tuple, whole)) == Counter(tuple(x)[:5] for x in after)


ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def batches(spark):
    """Rows and bytes of the Arrow batches in which 60 long texts reach Python."""

    def sizes(parts):
        for batch in parts:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    def run():
        texts = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("long text "), 20_000).alias("text"))
        return texts.mapInArrow(sizes, "n long, bytes long").collect()

    spark.conf.unset(ARROW)
    yield run
    spark.conf.unset(ARROW)


def test_long_texts_reach_python_in_small_batches(spark, small, batches):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    starts = [lambda: jaccard.near_duplicates(docs)]
    starts += [lambda stage=stage: stage(spark, docs, small) for _, stage in corpus_pipeline.STAGES]
    for start in starts:
        spark.conf.unset(ARROW)
        start()
        found = batches()
        assert sum(x["n"] for x in found) == 60
        assert max(x["bytes"] for x in found) <= BATCH_BYTES + 2 * 200_000


def test_smaller_bounds_of_the_session_stay(spark, batches):
    for given, wanted in (("1m", "1m"), ("4096", "4096"), ("512KB", "512KB"), ("3m", str(BATCH_BYTES)), ("1g", str(BATCH_BYTES))):
        spark.conf.set(ARROW, given)
        frames.small_batches(spark)
        assert spark.conf.get(ARROW) == wanted


def test_empty_tables(spark, tables, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    html = spark.createDataFrame([], "page_id long, url string, html string")
    talks = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    folder = tables(documents=nothing, labels=labels, benchmark=items, embeddings=vectors, pages=html, conversations=talks)
    for name, query in queries.QUERIES.items():
        assert query(spark, folder).collect() == [], name
    assert corpus_pipeline.run(spark, folder).collect() == []
    assert len(TEXTS) > 0
