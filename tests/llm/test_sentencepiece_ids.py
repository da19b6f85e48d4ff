import random
import zlib

import pytest
import sentencepiece
from pyspark.sql import functions as F

from veilframe.llm import queries, sentencepiece_ids as sp


@pytest.fixture(scope="module")
def pieces():
    return sp.load(queries.MODEL_FILE)


def viterbi(text, p):
    """The whole table at once: the largest sum of scores."""
    best, back = [0.0], [0]
    for end in range(1, len(text) + 1):
        options = [(best[i] + p.scores[text[i:end]], -i) for i in range(end) if text[i:end] in p.scores]
        if text[end - 1] not in p.scores:
            options.append((best[end - 1] + p.fallback, -(end - 1) - 0.5))
        s, i = max(options)
        best.append(s)
        back.append(int(-i))
    out, end = [], len(text)
    while end:
        out.append(text[back[end] : end])
        end = back[end]
    return [i for x in reversed(out) for i in ((p.ids[x],) if x in p.ids else p.outside(x))]


def merged(text, p):
    """Pair after pair, the best score first, the leftmost of equal ones."""
    own = list(text)
    while pairs := [(-p.scores[m], i) for i in range(len(own) - 1) if (m := own[i] + own[i + 1]) in p.scores]:
        i = min(pairs)[1]
        own[i : i + 2] = [own[i] + own[i + 1]]
    return [i for x in own for i in ((p.ids[x],) if x in p.ids else p.outside(x))]


def encoded(text, p):
    """Without the mark that is put before a text."""
    out = {}
    sp.search([text], p, out)
    return memoryview(out[text]).cast("i").tolist()


def toy(words, kind=sp.UNIGRAM):
    ids = {w: i for i, w in enumerate(words)}
    score = (lambda w: -float(zlib.crc32(w.encode()) % 50 + 1)) if kind == sp.UNIGRAM else (lambda w: -float(zlib.crc32(w.encode()) % 20 + 20 * len(w)) if len(w) > 1 else -1e4)
    return sp.Pieces(ids, {w: score(w) for w in ids}, (), len(ids), [w.replace(sp.MARK, " ").encode() for w in ids], kind)


@pytest.mark.parametrize("kind", [sp.UNIGRAM, sp.BPE])
@pytest.mark.parametrize("seed", range(30))
def test_streaming_is_exact(seed, kind, monkeypatch):
    monkeypatch.setattr(sp, "STEPS", 37)
    rng = random.Random(seed)
    letters = "ab" + sp.MARK
    p = toy(sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(25)} | set("ab" if seed % 2 else "")), kind)
    want = viterbi if kind == sp.UNIGRAM else merged
    texts = ["".join(rng.choice(letters + "z") for _ in range(n)) for n in (600, 1, 2, 3, 36, 37, 38, 80)]
    for text in texts:
        assert encoded(text, p) == want(text, p)
    before, out = p.commits, {}
    sp.search(texts, p, out)
    assert p.commits - before > len(texts) + 5  # most of them within a text
    assert all(memoryview(out[t]).cast("i").tolist() == want(t, p) for t in texts)


@pytest.mark.parametrize("kind", [sp.UNIGRAM, sp.BPE])
def test_window_stays_short(kind):
    p = toy(["a", "aa", "aaa", "b"], kind)
    lanes = sp._Lanes(p, ["aaab" * 5000])
    no, ends = lanes.run()
    assert lanes.window <= 8 * p.longest and ends.tolist() == [no.size] and p.commits > 1000


def test_commits_before_the_end_of_documents(pieces):
    """Real texts are final stretch by stretch, and within a long stretch too."""
    rng = random.Random(4)
    text = " ".join("".join(rng.choice(["the", "qu", "ción", "x9", "über"]) for _ in range(rng.randint(1, 9))) for _ in range(400))
    pieces._memo.clear(), pieces._old.clear()
    before = pieces.commits
    sp.encode_text(text, pieces)
    assert pieces.commits - before >= len(set(text.split())) > 200
    before = pieces.commits
    sp.encode_text("the" * 5000, pieces)
    assert pieces.commits - before > 500


def as_unigram(path):
    """The model file with its type, field 3 of the message in field 2, set to unigram."""
    data = open(path, "rb").read()
    trainer = sp._field(data, 2)
    at, i = data.index(trainer), 0
    while trainer[i] != 3 << 3:
        n, j = sp._varint(trainer, i)
        i = sp._varint(trainer, j)[1] if n & 7 == 0 else j + 4 if n & 7 == 5 else sum(sp._varint(trainer, j))
    changed = bytearray(data)
    changed[at + i + 1] = sp.UNIGRAM
    return bytes(changed)


TEXTS = ["Hello world", "Thouonan. On inly", "étre de étionen", "über schöne Häuser", "ñuega llieado", "x", "a b c", "The ththing!", "  two  spaces ", "tab\tline\n", "日本 \U0001f600 ok", "a" * 5000, "▁mark ▁▁", "oneable", "=" * 700, "the" * 900, "word, " * 50]


def test_the_library_gives_the_same_ids(pieces):
    model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL_FILE)
    assert pieces.kind == sp.BPE
    for text, ids in zip(TEXTS, sp.encode_texts(TEXTS, pieces)):
        assert memoryview(ids).cast("i").tolist() == model.encode(text), text


def test_same_sums_as_the_library_for_a_unigram_model(tmp_path):
    (tmp_path / "unigram.model").write_bytes(as_unigram(queries.MODEL_FILE))
    own = sp.load(str(tmp_path / "unigram.model"))
    model = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model"))
    assert own.kind == sp.UNIGRAM
    score = lambda ids: sum(own.scores[x] if (x := model.id_to_piece(i)) in own.scores else 0 for i in ids)
    for text in TEXTS:
        ours = memoryview(sp.encode_text(text, own)).cast("i").tolist()
        assert score(ours) == score(model.encode(text)), text
        assert model.decode(ours) == text.replace(sp.MARK, " ") == sp.decode_ids(ours, own)


def test_round_trips(spark, pieces):
    texts = ["", " ", "  two  spaces ", "tab\tline\n", "日本 \U0001f600 ok", "a" * 5000, "word " * 20_000, "\u0000 x", "no-break space"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(99, None), (0, ""), (None, "id is null")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    encoded = sp.encode(df, pieces)
    got = sp.decode(encoded.withColumn("decoded", F.lit(1)), pieces).collect()
    assert len(got) == len(rows)
    want = dict(rows)
    for r in got:
        assert r.decoded == want[r.doc_id] and (r.ids is None) == (want[r.doc_id] is None)
        if r.doc_id in (2, 4, 8, None):
            assert r.ids == merged((sp.MARK + want[r.doc_id]).replace(" ", sp.MARK), pieces)
    assert sp.encode(df.limit(0), pieces).count() == 0


def test_query(spark, tmp_path):
    spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op6_sentencepiece"](spark, str(tmp_path)).collect()}
    assert got[1].decoded_crc32 == zlib.crc32(b"some text") and got[1].n_ids == len(got[1].ids)
    assert got[2].ids is None and got[2].decoded_crc32 is None
