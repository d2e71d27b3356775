import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from vecloom.plans import ingest as plan
from vecloom.plans.ingest import IngestOptions, ingest_corpus, metadata_lines, whole_text_options
from vecloom.sources import corpus as corpus_source
from vecloom.sources.files import read_metadata_lines, write_metadata_lines
from vecloom.store import open_store


def put(path, texts, name="text", **more):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({name: pa.array(texts, pa.string()), **more}), path)


def words(seed, length):
    base = f"w{seed} alpha beta gamma delta "
    return (base * (length // len(base) + 1))[:length].strip().ljust(length, "x")


def expected(files):
    """(file, row, chunk index, chunk) of all kept chunks in file order."""
    out = []
    for name in sorted(files):
        for row, text in enumerate(files[name]):
            s = (text or "").strip()
            if 80 <= len(s) <= 8000:
                out += [(name, row, i // 900, s[i : i + 1000]) for i in range(0, len(s), 900) if len(s[i : i + 1000]) >= 80]
    return out


@pytest.fixture
def corpus(tmp_path):
    root = str(tmp_path / "in")
    files = {
        "a.parquet": [words(i, 60 + 37 * i) for i in range(30)] + [None, "", "   "],
        "b.parquet": [words(i, 8002 - i) for i in range(6)],
        "sub/c.parquet": ["  " + words(9, 979) + " ", words(1, 980), words(2, 1001)],
    }
    for name, texts in files.items():
        put(f"{root}/{name}", texts, "content" if name.startswith("sub") else "text")
    put(f"{root}/no.parquet", ["x"], "html")
    with open(f"{root}/zz_bad.parquet", "w") as out:
        out.write("bad")
    return root, files


def stored(store):
    rows = store.items().orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(1, len(rows) + 1))
    return rows


def names(rows, root):
    return [(r.source_file.split(root + "/")[1], r.source_row, r.chunk_index) for r in rows]


def test_ingest_numbers_chunks_in_file_order(spark, store, encoder, corpus):
    root, files = corpus
    report = ingest_corpus(store, root, encoder, IngestOptions(keep_text=True, doc_type="web"))
    rows, wanted = stored(store), expected(files)
    assert names(rows, root) == [w[:3] for w in wanted]
    assert [r.text for r in rows] == [w[3] for w in wanted]
    assert report.added == len(wanted) == store.head.next_id - 1
    first = rows[0].metadata
    assert first["url"] == f"http://fw2.local/a.parquet-{rows[0].source_row}" and first["doc_type"] == "web"
    ledger = {r.path.split(root + "/")[1]: r for r in store.processed().collect()}
    assert ledger["no.parquet"].status == "no_text_column" and ledger["zz_bad.parquet"].status == "unreadable"
    for name, texts in files.items():
        sent = sum(80 <= len((t or "").strip()) <= 8000 for t in texts)
        assert (ledger[name].status, ledger[name].rows_sent, ledger[name].rows_skipped) == ("ok", sent, len(texts) - sent)
    assert report.rows_sent == sum(r.rows_sent for r in ledger.values())
    assert report.as_frame(spark).first().added == report.added and report.vectors_per_second > 0


def test_second_run_adds_only_new_files(spark, store, encoder, corpus):
    root, files = corpus
    ingest_corpus(store, root, encoder)
    before = store.items().count()
    assert ingest_corpus(store, root, encoder).files == 0 and store.items().count() == before
    put(f"{root}/new.parquet", [words(5, 500)])
    again = open_store(spark, store.root)
    assert ingest_corpus(again, root, encoder).added == 1
    assert stored(again)[-1].source_file.endswith("new.parquet")


@pytest.mark.parametrize("options", [{"files_per_slice": 1}, {"bytes_per_slice": 1}, {"files_per_slice": 2}])
def test_slices_give_the_same_ids(spark, store, encoder, corpus, options):
    root, files = corpus
    report = ingest_corpus(store, root, encoder, IngestOptions(**options))
    assert len(report.commits) > 1
    assert names(stored(store), root) == [w[:3] for w in expected(files)]


def test_small_staged_files_keep_the_order(spark, store, encoder, corpus, monkeypatch):
    root, files = corpus
    whole = plan.numbering.stage
    monkeypatch.setattr(plan.numbering, "stage", lambda df, label: whole(df, label, rows_per_file=3))
    monkeypatch.setattr(plan, "spread_in_order", lambda df, size, *keys: df)
    ingest_corpus(store, root, encoder)
    assert names(stored(store), root) == [w[:3] for w in expected(files)]


@pytest.mark.parametrize("limit", [1, 7, 28, 33, 1000])
def test_limit_is_exact_and_keeps_the_first_rows(spark, store, encoder, corpus, limit):
    root, files = corpus
    report = ingest_corpus(store, root, encoder, whole_text_options(limit=limit, files_per_slice=2))
    band = [(n, i, t.strip()) for n in sorted(files) for i, t in enumerate(files[n]) if t and 80 <= len(t.strip()) <= 8000]
    rows = stored(store)
    assert [(r.source_file.split(root + "/")[1], r.source_row, r.text) for r in rows] == band[:limit]
    assert report.rows_sent == min(limit, len(band))
    assert all(r.metadata["doc_type"] == "fineweb2" and r.metadata["url"] for r in rows)


def test_whole_texts_continue_an_existing_store(spark, store, encoder, corpus):
    root, _ = corpus
    ingest_corpus(store, root, encoder, whole_text_options(), allow=["a.parquet"])
    n = store.items().count()
    ingest_corpus(store, root, encoder, whole_text_options(), allow=["b.parquet"])
    assert [r.vec_id for r in store.items().where("source_file LIKE '%b.parquet'").orderBy("vec_id").collect()][0] == n + 1


def test_a_file_that_breaks_off_is_failed_and_retried(spark, store, encoder, corpus, monkeypatch):
    root, files = corpus
    whole = corpus_source._read_group

    def broken(spark, key, paths):
        rows = whole(spark, key, paths)
        return rows.where("NOT (file_uri LIKE '%b.parquet' AND row_index > 2)")

    monkeypatch.setattr(corpus_source, "_read_group", broken)
    ingest_corpus(store, root, encoder)
    status = {r.path.split(root + "/")[1]: r.status for r in store.processed().collect()}
    assert status["b.parquet"] == "failed" and status["a.parquet"] == "ok"
    good = {n: t for n, t in files.items() if n != "b.parquet"}
    assert names(stored(store), root) == [w[:3] for w in expected(good)]
    monkeypatch.setattr(corpus_source, "_read_group", whole)
    assert ingest_corpus(store, root, encoder).files == 1
    assert sorted(names(stored(store), root)) == sorted(w[:3] for w in expected(files))


def test_run_that_dies_before_commit_is_repeated(spark, store, encoder, corpus, monkeypatch):
    root, files = corpus

    def die(**_):
        raise KeyboardInterrupt

    monkeypatch.setattr(store, "commit", die)
    with pytest.raises(KeyboardInterrupt):
        ingest_corpus(store, root, encoder)
    fresh = open_store(spark, store.root)
    assert fresh.items().count() == 0 and fresh.processed().count() == 0
    ingest_corpus(fresh, root, encoder)
    assert names(stored(fresh), root) == [w[:3] for w in expected(files)]


def test_other_dimension_is_refused(spark, store, encoder, corpus):
    from vecloom.functions.encoders import HashingEncoder

    ingest_corpus(store, corpus[0], encoder, allow=["a.parquet"])
    with pytest.raises(ValueError, match="dimension"):
        ingest_corpus(store, corpus[0], HashingEncoder(8))


def test_chunk_size_below_the_minimum_is_refused():
    with pytest.raises(ValueError):
        IngestOptions(chunk_size=50)


def test_metadata_lines_of_a_store(spark, store, encoder, corpus, tmp_path):
    ingest_corpus(store, corpus[0], encoder, allow=["a.parquet"])
    path = str(tmp_path / "lines")
    write_metadata_lines(metadata_lines(store), path)
    lines = read_metadata_lines(spark, path)
    assert lines.count() == store.items().count()
    assert lines.first().url.startswith("http://fw2.local/a.parquet-") and len(lines.first().created_at) == 19




def test_names_and_columns_that_spark_takes_for_something_else(spark, store, encoder, tmp_path):
    root = str(tmp_path / "in")
    files = {name: [words(i, 200), words(i + 20, 300)] for i, name in enumerate(["a[1].parquet", "b{x,y}.parquet", "c*?.parquet", "d e.parquet"])}
    for name, texts in files.items():
        put(f"{root}/{name}", texts)
    put(f"{root}/_x.parquet", [words(3, 200)])
    put(f"{root}/_dir/y.parquet", [words(4, 200)])
    put(f"{root}/two.parquet", [words(5, 200)], "text", Text=["other"])
    report = ingest_corpus(store, root, encoder)
    assert report.added == 8 and store.items().select("source_file").distinct().count() == 4
    assert sorted(p.split(root + "/")[1] for p in report.hidden) == ["_dir/y.parquet", "_x.parquet"]
    status = {r.path.rsplit("/", 1)[1]: r.status for r in store.processed().collect()}
    assert status["two.parquet"] == "ambiguous_column" and sorted(status.values()).count("ok") == 4


@pytest.mark.parametrize("limits", [(2,), (1, 2, 4)])
def test_a_row_limit_loses_nothing(spark, store, encoder, tmp_path, limits):
    root = str(tmp_path / "in")
    files = {"a.parquet": [words(1, 100), "short", words(2, 1200), words(3, 90)], "b.parquet": ["x", words(4, 100), None, words(5, 2000)]}
    for name, texts in files.items():
        put(f"{root}/{name}", texts)
    left = 5
    for limit in limits:
        assert ingest_corpus(store, root, encoder, IngestOptions(limit=limit)).rows_sent == min(limit, left)
        left -= min(limit, left)
    ingest_corpus(store, root, encoder)
    assert names(stored(store), root) == [w[:3] for w in expected(files)]
    assert ingest_corpus(store, root, encoder).added == 0
    totals = store.processed().groupBy().sum("rows_sent", "rows_skipped").first()
    assert tuple(totals) == (5, 3)


def test_lines_are_exported_once(spark, store, encoder, tmp_path, monkeypatch):
    """Over a run that dies before it publishes, a repeated one and two that begin at the same id."""
    from vecloom.plans.ingest import export_metadata_lines
    from vecloom.sources import files

    root, out = str(tmp_path / "in"), str(tmp_path / "out [1]")
    put(f"{root}/a.parquet", [words(1, 300), words(2, 300)])
    ingest_corpus(store, root, encoder)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(files, "rename_folder", dies)
        with pytest.raises(OSError):
            export_metadata_lines(store, out)
    assert files.export_watermark(spark, out) == 0
    assert export_metadata_lines(store, out) == 2 and export_metadata_lines(store, out) == 0
    put(f"{root}/b.parquet", [words(3, 300)])
    ingest_corpus(store, root, encoder)
    with monkeypatch.context() as late:
        late.setattr(files, "export_watermark", lambda *_: 0)  # has not seen the first export
        with pytest.raises(RuntimeError):
            export_metadata_lines(store, out)
    assert export_metadata_lines(store, out) == 1
    assert sorted(r.id for r in files.read_exported_lines(spark, out).collect()) == [1, 2, 3]
