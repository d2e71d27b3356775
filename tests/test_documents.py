import hashlib

import pytest
from pyspark.sql import functions as F

from vecloom.plans.documents import (
    ingest_markdown,
    ingest_markdown_page,
    upsert_document,
    upsert_documents,
)
from vecloom.store import open_store


def ref(text):
    return "doc_" + hashlib.sha1(text.encode()).hexdigest()[:12]


def frame(spark, texts, **extra):
    rows = [(i, t, *[v for v in extra.values()]) for i, t in enumerate(texts)]
    names = "".join(f", {name} string" for name in extra)
    return spark.createDataFrame(rows, f"seq bigint, text string{names}").repartition(3)


def test_copies_blanks_and_known_documents(spark, store, encoder):
    texts = ["first text", "second text", "first text", None, "   ", "", " first text"] + ["copy"] * 40
    report = upsert_documents(store, frame(spark, texts), encoder)
    status = {r.seq: (r.status, r.doc_ref, r.total_chunks) for r in report.status.collect()}
    assert status[0] == ("added", ref("first text"), 1) and status[2] == ("exists", ref("first text"), None)
    assert status[6][0] == "added"  # the hash is of the unstripped text
    assert [status[i][0] for i in (3, 4, 5)] == ["rejected"] * 3 and status[3][1] is None
    assert [status[i][0] for i in range(7, 47)] == ["added"] + ["exists"] * 39
    assert (report.documents, report.added) == (4, 4)

    again = upsert_documents(open_store(spark, store.root), frame(spark, ["second text", "third"]), encoder)
    assert {r.seq: r.status for r in again.status.collect()} == {0: "exists", 1: "added"}
    store.refresh()
    assert store.documents().count() == 5 and sorted(r.vec_id for r in store.items().collect()) == [1, 2, 3, 4, 5]


def test_chunks_are_consecutive_and_described(spark, store, encoder):
    long = "".join(chr(97 + i % 26) for i in range(4000))
    report = upsert_documents(store, frame(spark, [long, "short one"], url="http://u", title="t", doc_type="d"), encoder)
    row = report.status.where("seq = 0").first()
    chunks = store.chunks().where(F.col("doc_ref") == ref(long)).orderBy("chunk_index").collect()
    assert [c.vec_id for c in chunks] == list(range(row.first_id, row.first_id + 4))
    assert [(c.char_start, c.char_end) for c in chunks] == [(0, 1500), (1300, 2800), (2600, 4000), (3900, 4000)]
    assert all(c.h_path == ["# Loose"] and c.total_chunks == 4 and len(c.external_id) == 36 for c in chunks)
    assert chunks[3].sha1 == hashlib.sha1(long[3900:].encode()).hexdigest()
    registry = store.documents().where(F.col("doc_id") == ref(long)).first()
    assert (registry.url, registry.title, registry.doc_type, registry.total_chunks) == ("http://u", "t", "d", 4)
    assert registry.full_text is None and registry.full_text_sha1 == hashlib.sha1(long.encode()).hexdigest()


def test_first_metadata_wins(spark, store, encoder):
    rows = spark.createDataFrame([(2, "same", "late"), (1, "same", "early")], "seq bigint, text string, url string")
    upsert_documents(store, rows, encoder)
    upsert_documents(store, frame(spark, ["same"], url="later still"), encoder)
    assert [r.url for r in store.documents().collect()] == ["early"]


def test_full_text_only_on_request(spark, tmp_path, encoder):
    store = open_store(spark, str(tmp_path / "s"), keep_full_text=True)
    text = "z" * 3000
    upsert_documents(store, frame(spark, [text]), encoder)
    assert [r.full_text for r in store.documents().collect()] == [text]


def test_single_document(spark, store, encoder):
    made = upsert_document(store, encoder, "hello world", external_id="mine", metadata={"url": "http://u"}, chunk_size=5, overlap=2)
    assert made["doc_ref"] == ref("hello world") and made["ids"] == [1, 2, 3, 4] and made["total_chunks"] == 4
    assert set(made["timings"]) == {"chunk_ms", "encode_ms", "add_ms", "total_ms"}
    assert {r.external_id for r in store.items().collect()} == {"mine"}
    assert upsert_document(store, encoder, "hello world") == {"doc_ref": made["doc_ref"], "status": "exists"}
    for blank in (None, "", "  "):
        with pytest.raises(ValueError):
            upsert_document(store, encoder, blank)


def test_markdown_pages(spark, store, encoder):
    pages = [
        (0, "http://a", "# Title\nbody [label](http://x) ![i](p)", "SERVICE"),
        (1, "ftp://a", "# T", "x"),
        (2, None, "# T", "x"),
        (3, "https://a", "![only](image.png) http://gone", "x"),
        (4, "https://b", "# Title\r\nbody [label](http://other) ", "Blog"),
        (5, "https://c", None, "x"),
    ]
    df = spark.createDataFrame(pages, "seq int, url string, raw_markdown string, doc_type string")
    rows = {r.seq: r for r in ingest_markdown(store, df, encoder).collect()}
    assert [rows[i].status for i in range(6)] == ["added", "rejected", "rejected", "rejected", "exists", "rejected"]
    assert [rows[i].success for i in range(6)] == [True, False, False, False, True, False]
    assert rows[1].reason == rows[2].reason == "invalid url" and rows[3].reason == "empty markdown after cleaning"
    assert (rows[0].title, rows[0].doc_type, rows[0].language, rows[0].total_chunks) == ("Title", "service", "tr", 1)
    assert rows[4].doc_ref == rows[0].doc_ref == ref("# Title\nbody label") and rows[4].total_chunks is None
    assert rows[0].model_name == encoder.name and rows[0].dim == encoder.dim
    registry = store.documents().first()
    assert (registry.url, registry.title, registry.doc_type) == ("http://a", "Title", "service")


def test_single_markdown_page(spark, store, encoder):
    assert ingest_markdown_page(store, encoder, "http://a", "# T\nx").status == "added"
    with pytest.raises(ValueError, match="invalid url"):
        ingest_markdown_page(store, encoder, "nope", "# T")
    with pytest.raises(ValueError, match="empty"):
        ingest_markdown_page(store, encoder, "http://a", "https://only.url")


def test_texts_are_not_shuffled(spark, store, encoder):
    from vecloom.operators import numbering
    from vecloom.operators.dedup import first_seq, rows_of
    from vecloom.plans.documents import document_rows, judged_rows

    docs = document_rows(frame(spark, ["a", "b"]))
    winners = first_seq(judged_rows(docs).where("NOT blank"), "seq", store.documents(), store.known_hashes()).select("seq")
    winners = numbering.stage(winners, "winners").read()
    text = rows_of(docs, winners, "seq")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_membership_bitmaps(spark):
    """No known hash is said to be new, and few new ones are said to be known."""
    from vecloom.operators import membership

    assert [membership.bits_for(n) for n in (0, 1, 2048, 2049, 10**9)] == [15, 15, 15, 16, 34]
    hashes = spark.range(6000).select("id", F.sha1(F.col("id").cast("string").cast("binary")).alias("full_text_sha1"))
    parts = membership.bitmaps(hashes.where("id < 2000"), 2000).union(membership.bitmaps(hashes.where("id >= 1500 AND id < 3000"), 3000))
    known = membership.combined(parts.union(parts))
    assert sorted({r.bits for r in known.collect()}) == [15, 16]
    flagged = membership.with_maybe_known(hashes, known)
    assert flagged.where("id < 3000 AND NOT maybe_known").isEmpty()
    assert flagged.where("id >= 3000 AND maybe_known").count() < 3000 / 8
    assert membership.with_maybe_known(hashes, known.where("bits = 3")).where("maybe_known").isEmpty()


@pytest.mark.parametrize("bitmap_bytes", [0, 1 << 26])
def test_upsert_of_many_known_documents(spark, store, encoder, monkeypatch, bitmap_bytes):
    """The same status by sent hashes, by bitmaps and by comparing all rows."""
    from vecloom.operators import dedup, membership

    upsert_documents(store, frame(spark, [f"text {i}" for i in range(0, 60, 2)]), encoder)
    upsert_documents(store, frame(spark, [f"text {i}" for i in range(0, 60, 3)]), encoder)
    monkeypatch.setattr(dedup, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(membership, "MAX_BITMAP_BYTES", bitmap_bytes)
    report = upsert_documents(store, frame(spark, [f"text {i}" for i in range(80)] + [" "]), encoder)
    status = {r.seq: r.status for r in report.status.collect()}
    assert status == {i: "exists" if i < 60 and (i % 2 == 0 or i % 3 == 0) else "added" for i in range(80)} | {80: "rejected"}
    assert report.documents == report.added == sum(s == "added" for s in status.values())
    again = upsert_documents(store, frame(spark, [f"text {i}" for i in range(80)]), encoder)
    assert again.added == 0 and {r.status for r in again.status.collect()} == {"exists"}


def test_a_batch_without_bitmaps_is_compared_whole(spark, store, encoder, monkeypatch):
    from vecloom.operators import dedup

    upsert_documents(store, frame(spark, ["one", "two"]), encoder)
    monkeypatch.setattr(dedup, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr("vecloom.store.LAYOUT", None)  # written by an earlier release
    upsert_documents(store, frame(spark, ["three"]), encoder)
    monkeypatch.setattr("vecloom.store.LAYOUT", 2)
    store = open_store(spark, store.root)
    assert not store.has_layout and store.known_hashes() is None
    report = upsert_documents(store, frame(spark, ["one", "three", "four"]), encoder)
    assert {r.seq: r.status for r in report.status.collect()} == {0: "exists", 1: "exists", 2: "added"}
