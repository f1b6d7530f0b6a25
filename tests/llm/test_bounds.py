"""Memory bounds, the solver, and whole results of decontamination and the pipeline against brute force."""

import hashlib
import subprocess
import sys

import numpy as np
import pytest
from conftest import DATA, ROOT
from test_operators import FOLDER, classes_by_brute_force

import corpus_pipeline
from foliant.llm import bpe, decontaminate, pii, quality_classifier, queries

STRESS = """
import random, resource
import numpy as np
from foliant.llm import decontaminate as D

rng = random.Random(1)
word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
shared = "please read the following question with care and give the letter of the best answer that fits the text"
items = [(k, shared + " " + " ".join(word() for _ in range(8))) for k in range(5_000)]
texts = [" ".join([shared] * 19)[:1_900] + " " + word() for _ in range(8)]
def run(items, texts):
    codes, starts = D.fold(texts)
    ends = np.r_[starts[1:] - 1, len(codes) - 1]
    return {x: d for b in D.benchmarks(items) for x, d in b.found(codes, starts, ends).items()}
assert run(items, texts) == {(t, i): 0 for t in range(8) for i in range(5_000)}
assert run([(1, "a" * 2_000)], ["a" * 200_000]) == {(0, 0): 0}
assert run([(1, "a" * 39 + "b" * 41)], ["a" * 30_000]) == {}
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


def test_shared_passages_in_bounded_memory():
    """Thousands of items with one passage, texts that repeat it, and one character over and over."""
    run = subprocess.run([sys.executable, "-c", STRESS], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert int(run.stdout) < 600


def fewest_edits(window: np.ndarray, text: np.ndarray) -> int:
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for r, c in enumerate(window, 1):
        new = np.r_[r, np.minimum(row[1:] + 1, row[:-1] + (text != c))]
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def folded(text):
    codes, _ = decontaminate.fold([text or ""])
    return decontaminate.bare(codes[1:-1])


def contaminated_by_brute_force(docs, items, window=80, rate=0.05):
    """(id, item) to edits. An unedited piece of ``w // (k + 1)`` characters is in each window within the budget."""
    out = {}
    for item, of in items:
        own = folded(of)
        w = min(len(own), window)
        k = int(w * rate)
        if not w:
            continue
        size = w // (k + 1)
        pieces = {own[s : s + size].tobytes() for s in range(len(own) - size + 1)}
        for i, text in docs:
            codes = folded(text)
            if k == 0:
                best = 0 if f" {''.join(map(chr, own))} " in f" {''.join(map(chr, codes))} " else 1
            elif any(codes[s : s + size].tobytes() in pieces for s in range(len(codes) - size + 1)):
                best = min(fewest_edits(own[s : s + w], codes) for s in range(len(own) - w + 1))
            else:
                continue
            if best <= k:
                out[i, item] = best
    return out


@pytest.fixture(scope="module")
def leaks(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    return contaminated_by_brute_force(docs, items)


def test_decontamination_query(spark, leaks):
    got = {(r.doc_id, r.item_id): r.edits for r in queries.op5_decontaminate(spark, FOLDER).collect()}
    assert got.keys() == leaks.keys() and got
    assert all(leaks[x] <= d <= 4 and (d == 0) == (leaks[x] == 0) for x, d in got.items())


def test_blocks_of_a_benchmark(spark):
    """Small blocks, and a text that many items have."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    plain = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench, block_chars=2_000).collect())) == plain
    many = bench.crossJoin(spark.range(50).withColumnRenamed("id", "copy")).selectExpr("item_id * 100 + copy AS item_id", "text")
    got = sorted(map(tuple, decontaminate.contaminated(docs, many, block_chars=20_000).collect()))
    assert got == sorted((i, 100 * j + c, d) for i, j, d in plain for c in range(50))


def test_bpe_remembers_no_long_pieces():
    own = bpe.TrieBPE(bpe.read_spec(bpe.default_tokenizer("byte_bpe_50k.json")))
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer("byte_bpe_50k.json"))
    texts = [f"{'xq' * 3_000}{k} and short words {k}" for k in range(40)]
    for text in texts:
        assert own.encode_batch([text])[0] == bpe.packed(library.encode(text, add_special_tokens=False).ids)
    assert max(map(len, own.pieces)) <= bpe.LONG_PIECE and own.size < 40_000


def test_dual_coordinate_descent_is_the_minimum():
    """Against projected gradient steps on the whole dual problem, and the gap between primal and dual."""
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(12) < 0.4).astype(np.int32) for _ in range(40)]
    values = [rng.normal(size=len(r)) for r in rows]
    y = np.where(rng.random(40) < 0.5, 1.0, -1.0)
    cost = np.full(40, 0.7)
    w, bias = quality_classifier.dual_coordinate_descent(rows, values, y, cost, 2_000)
    dense = np.zeros((40, 13))
    for k, (r, v) in enumerate(zip(rows, values)):
        dense[k, r], dense[k, 12] = v, 1.0
    dense *= y[:, None]
    q = dense @ dense.T
    alpha, rate = np.zeros(40), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(50_000):
        alpha = np.clip(alpha + rate * (1 - q @ alpha), 0, cost)
    want = alpha @ dense
    assert np.abs(w[:12] - want[:12]).max() < 1e-2 and abs(bias - want[12]) < 1e-2
    primal = lambda x: x @ x / 2 + (cost * np.maximum(0, 1 - dense @ x)).sum()
    dual = alpha.sum() - want @ want / 2
    assert 0 <= primal(np.r_[w[:12], bias]) - dual < 1e-2


def test_log_count_ratio():
    rows = [np.array(x, np.int32) for x in ([0, 1], [0], [1, 2], [2])]
    y = np.array([1.0, 1.0, -1.0, -1.0])
    got, s = quality_classifier.log_count_ratio(rows, y), quality_classifier.SMOOTH
    share = lambda n: (n + s) / (2 + 2 * s)
    assert got[:4] == pytest.approx([np.log(share(a) / share(b)) for a, b in ((2, 0), (1, 1), (0, 2), (0, 0))])


def test_what_is_fitted_is_bounded_and_the_same_in_any_order(spark):
    rows = [(k % 300, f"word{k % 7} text number {k} of its own {'good' if k % 2 else 'bad'}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, quality int")
    one = quality_classifier.train(docs, labels, sample_rows=100)
    two = quality_classifier.train(docs.repartition(7), labels.repartition(3), sample_rows=100)
    assert (one.weight == two.weight).all() and one.slope == two.slope
    few = quality_classifier.train(docs, labels, sample_rows=100, sample_bytes=4_000)
    assert 0 < (few.ratio != few.ratio[0]).sum() < (one.ratio != one.ratio[0]).sum()


def test_pipeline_by_brute_force(spark, leaks):
    """run() against scores of its own classifier, all pairs of shingle sets, all windows, and the tokenizers library."""
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality_classifier.train(table, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = sorted(i for i, t in docs.items() if model.score(t) >= quality_classifier.THRESHOLD)
    classes = classes_by_brute_force([docs[i] for i in kept])
    first = [i for k, i in enumerate(kept) if classes[k] == k]
    clean = [i for i in first if i not in {d for d, _ in leaks}]
    assert len(docs) > len(kept) > len(first) > len(clean) > 0
    library = Tokenizer.from_file(bpe.default_tokenizer("byte_bpe_50k.json"))
    want = {}
    for i in clean:
        base = pii.base_spans(docs[i])
        ids = library.encode(pii.redacted(docs[i], base + pii.added_spans(docs[i], base)), add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == want


def test_stages_with_other_columns_text_ids_and_no_rows(spark, tmp_path):
    spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rng = np.random.default_rng(4)
    text = lambda: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(60))
    copy = text()
    rows = [("b", copy), ("a1", copy), ("a", copy), ("a", text()), (None, copy), ("é", f"{text()} The quick brown fox, jumps over the lazy dog!")]
    names = "doc_id string, text string, lang string, source string, n_chars long, key string, component_id int, hash string, fp int, edits int"
    spark.createDataFrame([], "doc_id string, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for n, some in ((2, rows), (0, [])):
        docs = spark.createDataFrame([(i, t, "en", "s", 1, "k", 2, "h", 3, 4) for i, t in some], names)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            docs, _ = decontaminate_written(docs)
        assert docs.count() == n
        assert n == 0 or sorted(r.doc_id for r in docs.collect()) == ["a", "a"]


def decontaminate_written(docs):
    from foliant.llm.common import written

    return written(docs, "stage")
