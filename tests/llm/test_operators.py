"""The operators on Spark: whole queries against brute force or their oracle, and odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
from compare import differences
from conftest import DATA
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from foliant.llm import bpe, decontaminate, license_scan, near_copies, pii, quality_classifier, quality_rules, queries, simhash, token_output, url_filter, warc

FOLDER = f"{DATA}/sf0.001"
DOC = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("id", T.StringType()), T.StructField("fp", T.LongType()), T.StructField("file", T.StringType())]
)


def documents(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def odd_rows(spark, empty=False):
    """Null ids and texts, an empty text, a very long one, repeated rows, columns with clashing names."""
    long = " ".join(f"w{k % 977}é" for k in range(60_000))
    rows = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, long), (5, "same words here for all " * 30), (6, "same words here for all " * 30)]
    return spark.createDataFrame([] if empty else [(i, t, "x", 7, "y") for i, t in rows], DOC)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_as_the_oracle(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert differences(df, queries.ORACLES[name], FOLDER) == ""


def test_pii_query(spark):
    got = {r.doc_id: r for r in queries.op3_pii(spark, FOLDER).collect()}
    docs = documents(spark)
    assert len(got) == len(docs)
    for i, text in docs:
        base = pii.base_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(s[2] == k for s in base) for k in pii.BASE]
        assert got[i].spans == pii.joined(base + pii.added_spans(text, base))


def test_bpe_query(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in queries.op4_bpe(spark, FOLDER).collect()}
    for i, text in documents(spark):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_simhash_query(spark):
    docs = sorted(documents(spark))
    fps = {i: simhash.fingerprint(t.encode()) & (2**64 - 1) for i, t in docs}
    component = {i: i for i in fps}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    ids = sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                ra, rb = sorted((root(a), root(b)))
                component[rb] = ra
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, FOLDER).collect()}
    assert got == {i: (f"{fps[i]:016x}", root(i)) for i in ids}


def test_classifier_query(spark):
    rows = queries.op8_quality_classifier(spark, f"{DATA}/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/sf0.01/labels.parquet").collect()}
    held = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    up, down = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([(a > b) + (a == b) / 2 for a in up for b in down])
    assert auc > 0.85, (auc, len(up), len(down))


def test_token_output_query(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    start, want = 0, []
    for i, text in sorted(documents(spark)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = queries.op9_token_output(spark, FOLDER).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want


def test_token_files(spark, tmp_path):
    """Files have Bloom filters, row indexes and run-length encoded integers, and a look-up by id reads few rows."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.crossJoin(spark.range(20)).select((F.col("doc_id") * 20 + F.col("id")).alias("doc_id"), "text")
    path = str(tmp_path / "ids")
    token_output.write_token_ids(docs, path, files=2, stripe_bytes=1 << 18, row_index_stride=1_000)
    jvm = spark.sparkContext._jvm
    stripes = 0
    for file in sorted((tmp_path / "ids").glob("*.orc")):
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(str(file)), jvm.org.apache.orc.OrcFile.readerOptions(spark.sparkContext._jsc.hadoopConfiguration()))
        assert reader.getRowIndexStride() == 1_000
        rows = reader.rows()
        for stripe in reader.getStripes():
            footer = rows.readStripeFooter(stripe)
            streams = [(s.getColumn(), s.getKind().name()) for s in footer.getStreamsList()]
            assert (1, "BLOOM_FILTER_UTF8") in streams and (1, "ROW_INDEX") in streams and (2, "BLOOM_FILTER_UTF8") not in streams
            assert [footer.getColumns(c).getKind().name() for c in (1, 3, 4)] == ["DIRECT_V2"] * 3
            stripes += 1
    assert stripes >= 2
    found = token_output.documents_by_id(spark, path, [41])
    assert [r.doc_id for r in found.collect()] == [41]
    plan = found._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    read = sum(scans.apply(k).metrics().apply("numOutputRows").value() for k in range(scans.size()))
    assert 0 < read < docs.count() / 2, read


def test_warc_query(spark):
    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    least = {}
    for i, p in pages:
        if len(p) >= 100:
            least[p] = min(i, least.get(p, i))
    want = {}
    for i, p in pages:
        first = least.get(p, i)
        want[i] = (len(p), hashlib.sha256(p).hexdigest(), "response" if first == i else "revisit", None if first == i else first)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op10_warc(spark, FOLDER).collect()}
    assert got == want


def test_warc_records(spark, tmp_path):
    """Small archives, references to record ids, hot digests by broadcast or not, and damaged records."""
    same = "<p>" + "s" * 200
    pages = [(k, f"http://h/{k}", same if k % 3 == 0 else f"{k} " * 8_000 if k % 50 == 1 else f"page {k}") for k in range(1, 401)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    seen = []
    for name, most in (("broadcast", 1000), ("shuffled", 0)):
        path = str(tmp_path / name)
        warc.write_warc(df, path, archive_bytes=1 << 20, broadcast_digests=most)
        files = sorted((tmp_path / name).glob("*.gz"))
        assert len(files) > 4 and max(sum(map(len, warc.inflated(f.read_bytes()))) for f in files) <= 1 << 20
        heads = [h for f in files for h, _ in warc.parse(f.read_bytes())]
        ids = [h["warc-record-id"] for h in heads]
        assert len(set(ids)) == len(ids)
        first = next(h["warc-record-id"] for h in heads if h.get("x-page-id") == "3")
        assert {h["warc-refers-to"] for h in heads if h["warc-type"] == "revisit"} == {first}
        got = {int(r.page): (bytes(r.payload).decode() if r.payload else None, r.record_type, r.refers_to) for r in warc.read_warc(spark, path).collect()}
        assert got == {k: (None, "revisit", "3") if t == same and k > 3 else (t, "response", None) for k, _, t in pages}
        seen.append(got)
    assert seen[0] == seen[1]
    # a cut archive: the last segments of some page are gone
    one = "".join(r + "\r\n\r\n" for r in warc.page_records("k", 7, None, b"z" * 50_000, hashlib.sha256(b"z" * 50_000).hexdigest(), None, 9_000)[:-1])
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc").write_text(one, newline="")
    rows = warc.read_warc(spark, str(tmp_path / "cut"), strict=False).collect()
    assert [(r.page, r.payload, "last segment" in r.error) for r in rows] == [("7", None, True)]
    with pytest.raises(Exception, match="last segment"):
        warc.read_warc(spark, str(tmp_path / "cut")).collect()


def test_hot_keys_are_spread(spark, monkeypatch):
    """One text repeated by the thousand, a star of links, and few rows to a hot key: the same classes as without."""
    from foliant.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 50)
    texts = ["one text of some words for all"] * 3_000 + [f"other text number {k} of its own" for k in range(40)] + [None] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for near in (simhash.near_duplicates, near_copies.near_copies):
        got = {r.doc_id: r.component_id for r in near(docs).collect()}
        assert len(got) == len(texts) and {got[k] for k in range(3_000)} == {0} and {got[k] for k in range(3_040, 3_060)} == {3_040}
    edges = spark.createDataFrame([(0, k) for k in range(1, 60)] + [(k, k + 100) for k in range(1, 60)] + [(300, 301), (301, 302)], "a long, b long")
    roots, _ = simhash.components(edges)
    assert {(r.node, r.root) for r in roots.collect()} == {(k, 0) for k in [*range(1, 60), *range(101, 160)]} | {(301, 300), (302, 300)}


def test_the_cascade_keeps_what_the_counts_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = lambda df: sorted((r.doc_id, r.kept) for r in df.collect())
    assert kept(quality_rules.judged(docs)) == kept(quality_rules.quality_rules(docs))
    odd = {(r.doc_id, r.n_words, r.word_chars, r.n_repeat_words, r.base_failed, r.kept) for r in quality_rules.quality_rules(odd_rows(spark)).collect()}
    long = odd_rows(spark).filter("doc_id = 4").first().text.split()
    assert odd == {(None, 0, 0, 0, True, False), (None, 3, 3, 0, True, False), (1, 0, 0, 0, True, False), (2, 0, 0, 0, True, False), (3, 3, 3, 0, True, False), (4, 60_000, sum(map(len, long)), 60_000, True, False), (5, 150, 570, 150, True, False), (6, 150, 570, 150, True, False)}


def test_license_query(spark):
    """Whole texts against all runs of words of the templates' sizes."""
    got = {r.doc_id: r for r in queries.op2_license_scan(spark, FOLDER).collect()}
    docs = documents(spark)
    assert len(got) == len(docs)
    sets = [(n, license_scan.bigrams(license_scan.words_of(t))) for n, t in license_scan.TEMPLATES]
    sets = [(n, s) for n, s in sets if len(s) < 15]
    hits = 0
    for i, text in docs:
        words, best = license_scan.words_of(text), 0.0
        pairs = list(zip(words, words[1:]))
        for name, own in sets:
            most = int(len(own) * 1.5)
            for s, p in enumerate(pairs):
                if p in own:
                    for e in range(s + 1, min(len(pairs), s + most) + 1):
                        unit = set(pairs[s:e])
                        best = max(best, 2 * len(unit & own) / (len(unit) + len(own)))
        if best >= 0.8:
            hits += 1
            assert got[i].dice == pytest.approx(best, abs=1e-6), i
        else:
            assert got[i].license is None, i
    assert hits >= 3
    odd = {r.doc_id for r in license_scan.scan_licenses(odd_rows(spark)).filter("license IS NULL AND licenses = '' AND spans = ''").collect()}
    assert odd == {None, 1, 2, 3, 4, 5, 6}


def test_near_copies_by_brute_force(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 6))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(300)]
        for swaps in (0, 0, 1, 3, 5, 30):
            own = list(base)
            for k in rng.integers(0, 300, swaps):
                own[k] = word()
            texts.append(" ".join(own))
    texts += ["", None, "one two", "One two"]
    sets = [set(near_copies.shingles((t or "").encode()).tolist()) for t in texts]
    component = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if not union or len(sets[a] & sets[b]) >= 0.8 * union:
                x, y = sorted((component[a], component[b]))
                component = [x if c == y else c for c in component]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(df, recall=0.9999).collect()}
    assert got == dict(enumerate(component))


def classes_by_brute_force(texts):
    sets = [set(near_copies.shingles((t or "").encode()).tolist()) for t in texts]
    component = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared) and component[a] != component[b]:
                x, y = sorted((component[a], component[b]))
                component = [x if c == y else c for c in component]
    return dict(enumerate(component))


def test_true_links_within_a_family_below_the_threshold(spark):
    """Hundreds of texts at 0.79 of each other don't crowd out pairs at 0.81."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 7))
    core = [word() for _ in range(89)]
    texts = []
    for k in range(480):
        texts.append(" ".join([*core, *(word() for _ in range(11))]))
        if k % 12 == 0:  # two words of the core changed and the own end kept
            own = texts[-1].split()
            for at in (30, 60):
                own[at] = word()
            texts.append(" ".join(own))
    want = classes_by_brute_force(texts)
    assert len(set(want.values())) == 480
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(df).collect()} == want


def test_no_near_copy_of_a_short_text_is_missed(spark):
    """Production parameters: 4 of 5 shingles, 9 of 11 and 26 of 32 shared, among unrelated texts."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 7))
    texts = []
    for k in range(900):
        own = [word() for _ in range((9, 15, 36)[k % 3])]
        cut = (1, 2, 6)[k % 3]
        texts += [" ".join(own), " ".join(own[:-cut])]
    want = {k: k - k % 2 for k in range(len(texts))}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(df).collect()} == want


def test_forests_and_shards(spark):
    """A subtree that is dealt out as shards has the same classes."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, 32, dtype=np.uint8)
    prints = {bytes(base)}
    while len(prints) < 300:
        own = np.unpackbits(base)
        own[rng.integers(0, 256, 12)] ^= 1
        prints.add(np.packbits(own).tobytes())
    fps = spark.createDataFrame([(bytearray(p),) for p in prints], "fp binary")
    links = near_copies.candidate_links(fps, len(prints), subtree_rows=20).collect()
    label = {p: p for p in prints}
    for r in links:
        x, y = sorted((label[bytes(r.a)], label[bytes(r.b)]))
        label = {k: x if v == y else v for k, v in label.items()}
    assert len(set(label.values())) == 1


ROWWISE = {
    "licenses": license_scan.scan_licenses,
    "pii": pii.pii_digest,
    "bpe": bpe.bpe_roundtrip,
    "rules": quality_rules.quality_rules,
    "simhash": simhash.near_duplicates,
    "near copies": near_copies.near_copies,
    "tokens": token_output.token_output,
}


@pytest.mark.parametrize("name", sorted(ROWWISE))
@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, name, empty):
    docs = odd_rows(spark, empty)
    got = ROWWISE[name](docs)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())


def test_odd_rows_of_classes(spark):
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(odd_rows(spark)).filter("doc_id IS NOT NULL").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5}


def test_odd_rows_of_the_classifier(spark):
    docs = odd_rows(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, text string")
    model = quality_classifier.train(docs, none)
    assert {r.score for r in quality_classifier.scored(docs, model).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2, "z") for i in range(1, 7)] + [(None, 1, "z"), (3, None, "z"), (3, 1, "z")], none.schema)
    scores = quality_classifier.scored(docs, quality_classifier.train(docs, labels)).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert quality_classifier.scored(odd_rows(spark, True), model).count() == 0


def test_odd_rows_of_decontamination(spark):
    item = "the quick brown fox jumps over the lazy dog and then runs away into the deep dark forest at night"
    docs = spark.createDataFrame([(1, None, 9), (None, f"x {item} y", 9), (2, f"Well: {item.upper()}!", 9), (2, f"Well: {item.upper()}!", 9), (3, item.replace("lazy", "lasy"), 9), (4, "clean", 9)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "")], "item_id int, text string")
    got = sorted((r.doc_id or 0, r.item_id, r.edits) for r in decontaminate.contaminated(docs, bench).collect())
    assert [x for x in got if x[0] != 3] == [(0, 7, 0)] * 2 + [(2, 7, 0)] * 4
    assert len(got) == 8
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_odd_rows_of_urls(spark):
    pages = spark.createDataFrame([(1, None, "q"), (None, "http://A.b.com/en/x", "q"), (2, "nothing", "q"), (3, "x://b.com", "q"), (3, "x://b.com", "q"), (4, "http://b.com/EN/", "q")], "page_id long, url string, key string")
    rules = spark.createDataFrame([("com", "/en/", "block"), ("com", "/en/", "allow"), ("b.com", "", "block")], url_filter.RULE)
    got = sorted(((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()), key=repr)
    assert got == [(0, "a.b.com", "/en/x", "com/en/", "allow"), (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "b.com", "", "b.com", "block"), (3, "b.com", "", "b.com", "block"), (4, "b.com", "/EN/", "b.com", "block")]
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_odd_rows_of_warc(spark):
    same = "<p>" + "é" * 200
    pages = spark.createDataFrame([(1, None, None, 1), (None, "http://x/\n", same, 1), (2, "u", same, 1), (2, "u", same, 1), (3, "u", "z" * 200_000 + "\r\n\r\nWARC/1.1\r\n", 1)], "page_id long, url string, html string, segment int")
    got = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.warc_roundtrip(pages).collect()), key=repr)
    assert got == [(0, 403, "revisit", 2), (1, 0, "response", None), (2, 403, "response", None), (2, 403, "response", None), (3, 200014, "response", None)]
    assert warc.warc_roundtrip(pages.limit(0)).count() == 0


def test_pipeline(spark):
    """Each stage decides as its operator does on the stage's own input, and keeps the columns."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = [{r.doc_id for r in docs.collect()}]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        path = near_copies.written(out, "stage")[1]
        out = spark.read.schema(out.schema).parquet(path)
        ids.append({r.doc_id for r in out.select("doc_id").collect()})
        assert out.count() == len(ids[-1]) and ids[-1] <= ids[-2]
        if k < 4:
            assert out.columns == docs.columns
        if k == 1:
            classes = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
            assert ids[-1] == set(classes.values()) and len(ids[-1]) < len(ids[-2])
        if k == 2:
            found = {r.doc_id for r in decontaminate.contaminated(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
            assert ids[-1] == ids[-2] - found and found
        if k == 3:
            before = {r.doc_id: r.text for r in docs.collect()}
            for r in out.collect():
                base = pii.base_spans(before[r.doc_id] or "")
                assert r.text == pii.redacted(before[r.doc_id], base + pii.added_spans(before[r.doc_id], base)) and r.n_chars == len(r.text)
        if k < 4:
            docs = out
    got = {r.doc_id: r for r in out.collect()}
    encoder = bpe.encoder(bpe.read_spec(bpe.default_tokenizer("byte_bpe_50k.json")))
    for r in docs.collect():
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(encoder.encode_batch([r.text])[0]).hexdigest()
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, out.collect()))
    assert whole.agg(F.count("*")).first()[0] == len(ids[-1])


def test_odd_rows_through_every_stage(spark, tmp_path):
    """Rows are judged one by one: neither null nor repeated ids take clean rows along, and a class keeps one row."""
    rng = np.random.default_rng(4)
    text = lambda: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(60))
    copy, clean, other, twice, nobody, leak = (text() for _ in range(6))
    rows = [(5, copy), (None, copy), (None, clean), (5, other), (3, twice), (3, twice), (None, nobody), (None, nobody), (None, f"{text()} {leak} x"), (None, None), (8, ""), (-2, copy), (9, leak), (9, text())]
    docs = spark.createDataFrame([(i, t, "en", "s", 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, leak)], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stored = spark.read.parquet(str(tmp_path / "documents.parquet"))
    order = lambda rows: sorted(rows, key=repr)
    for given in (docs, stored):
        got = order((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, given, str(tmp_path)).collect())
        assert got == order([(-2, copy), (None, clean), (5, other), (3, twice), (None, nobody), rows[8], (8, ""), (9, leak), rows[13]])
        got = order((r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, given, str(tmp_path)).collect())
        assert got == order(r for k, r in enumerate(rows) if k not in (8, 12))
    assert corpus_pipeline.keep_quality(spark, stored, str(tmp_path)).count() == len(rows)
    assert corpus_pipeline.redact_pii(spark, stored, str(tmp_path)).count() == len(rows)
    assert corpus_pipeline.encode(spark, stored, str(tmp_path)).count() == len(rows)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 7
