"""Operators against brute force, over a whole small table and over hand-made edge rows."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM, SMALL
from tests.llm import brute
from turnout.llm import decontaminate, line_dedup, pii, piece_codec, quality_rules, simhash_index, token_io
from turnout.llm.queries import queries

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CARD = "4539 1488 0343 6467"
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "the same\nthe same\nthe same"), (6, "the same\nthe same\nthe same"),
    (7, "a b c d " * 5000), (8, " leading  double \n\n spaces\ttabs \x0b \x85 é　ü "), (9, "日本語 text 😀 <|endoftext|> ▁x ▁▁ y"),
    (10, f"mail a.b@c.de, x@y, p@q.r.s card {CARD} {CARD}1 ip 1.2.3.4.5.6.7.8 999.1.1.1 255.255.255.255 call +1 (555) 010-9999 +12"),
    (11, "GB82 WEST 1234 5698 7654 32 is an account, GB82 WEST 1234 5698 7654 33 is not"), (12, "1 2 3 4 5 6 7 8 9 " * 300),
    (13, "x" * 20000), (14, "."), (14, "."), (15, "A\n" * 300), (16, "The THE the " * 40),
]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    return rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_token_files_round_trip(spark, docs_of, small):
    for rows in (small, EDGES, []):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(BYTES)
        want, start = [], 0
        for i, t in sorted(rows, key=lambda r: r[0]):
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
            want.append((i, start, len(ids), ids))
            start += len(ids)
        tokens = token_io.write_tokens(docs_of(rows), BYTES, block_ids=500)
        assert rows_of(token_io.read_tokens(tokens)) == sorted(want, key=str)
        crc = [(i, s, n, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))) for i, s, n, ids in want]
        assert rows_of(token_io.token_checksums(tokens)) == sorted(crc, key=str)


def test_simple8b_words():
    import numpy as np
    rng = np.random.default_rng(0)
    for ids in ([], [0], [0] * 500, [1] * 61, list(range(400)), [2**60 - 1, 2**60, 2**64 - 1, 5], rng.integers(0, 50257, 3000),
                rng.integers(0, 2, 1000), np.concatenate([np.zeros(239, int), [7], np.zeros(121, int)])):
        ids = np.array(ids, dtype=np.uint64)
        packed = token_io.pack(ids)
        assert (token_io.unpack(packed) == ids).all()
        for _ in range(20):
            a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
            assert (token_io.unpack(packed, a, b) == ids[a:b]).all()
    assert len(token_io.pack(np.zeros(2400, np.uint64))) < 8 * 16  # runs of zeros take a word per 240


def test_pieces_equal_the_library(docs_of, small):
    import sentencepiece
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    random.seed(3)
    noise = [(100 + k, "".join(random.choice(" \n\tab'sé  the▁日😀.,|") for _ in range(90))) for k in range(300)]
    for rows in (small, EDGES + noise, []):
        got = {r.doc_id: r for r in piece_codec.encode_decode(docs_of(rows), PIECES).collect()}
        for i, t in rows:
            ids = processor.encode(t or "")
            assert got[i].ids == ids and got[i].decoded == processor.decode(ids) and got[i].n_differ == 0
    digest = piece_codec.digests(piece_codec.encode_decode(docs_of([(1, "a b")]), PIECES)).first()
    ids = processor.encode("a b")
    assert digest.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and digest.n_tokens == len(ids)


def test_whole_texts_are_checked(monkeypatch):
    from turnout.llm.common import LETTERS, PieceCache
    processor, vocabulary, _ = piece_codec._model(PIECES)
    texts = ["", "the same words", "of the people", "a"]
    right = [processor.encode(t) for t in texts]

    def encoded():
        ids, until, differ, same = piece_codec.encode_texts(texts, PIECES)
        assert same == right
        return [ids[a:b].tolist() for a, b in zip(until, until[1:])], differ.tolist()

    assert encoded() == (right, [False] * 4)
    # parts cut inside words: each is right by itself, the texts are not
    monkeypatch.setattr(piece_codec, "_cuts", lambda raw, _: raw.behind_letter() & LETTERS[raw.at])
    monkeypatch.setitem(piece_codec._LOADED, PIECES, (processor, vocabulary, PieceCache()))
    assert encoded() == (right, [False, True, True, False])
    # the agenda's ids are the ones that are counted: a vocabulary that merges nothing is seen
    monkeypatch.undo()
    monkeypatch.setattr(vocabulary, "encode", lambda words: [[vocabulary.unknown]] * len(words))
    monkeypatch.setitem(piece_codec._LOADED, PIECES, (processor, vocabulary, PieceCache()))
    assert encoded() == (right, [False, True, True, True])


def library(processor, words):
    """What the library makes of normalised parts.  It adds the first space mark itself; a part that starts
    otherwise follows a letter in its text, so it is encoded behind one, whose ids are then taken off."""
    mark, letter = piece_codec.MARK, processor.encode("a")
    found = processor.encode([w[1:].replace(mark, " ") if w[0] == mark else "a" + w.replace(mark, " ") for w in words], num_threads=1)
    # an empty text gets no first mark, so a mark on its own is looked up instead
    return [[processor.piece_to_id(mark)] if w == mark else ids if w[0] == mark else ids[len(letter):] for w, ids in zip(words, found)]


def test_long_and_short_agendas_agree():
    processor, vocabulary, _ = piece_codec._model(PIECES)
    random.seed(5)
    words = ["▁" + "".join(random.choice("theranding'é日x") for _ in range(n)) for n in [0, 1, 2, 3, 7, 20, 63, 64, 65, 200] * 8]
    assert vocabulary.encode(words) == [vocabulary._agenda(w) for w in words] == library(processor, words)


def test_pair_table_finds_every_pair():
    import numpy as np
    _, vocabulary, _ = piece_codec._model(PIECES)
    keys = np.array(list(vocabulary.pairs), dtype=np.int64)
    rank, merged = vocabulary.look_up((keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32))
    assert list(zip(merged.tolist(), rank.tolist())) == list(vocabulary.pairs.values())
    rank, _ = vocabulary.look_up(np.array([-1, -2, 5, -1], np.int32), np.array([-1, 5, -2, 7], np.int32))
    assert (rank == piece_codec.NONE).all()


BREAKS = " \n\t\x0b\x1c\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000"


def test_cuts_encode_as_whole_texts(spark, docs_of):
    """Texts made of white space, stops and letters in any order, against the library on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer
    tokenizer, processor = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    random.seed(8)
    texts = ["".join(random.choice(BREAKS * 2 + "ab'sZé÷×“’.,!?;:1日😀▁\0|#" + "  \n") for _ in range(40)) for _ in range(2000)] + [" ", "\n", "a", ""]
    ids, until = token_io.token_ids(texts, BYTES)
    for k, t in enumerate(texts):
        assert ids[until[k]:until[k + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
    ids, until, differ, _ = piece_codec.encode_texts(texts, PIECES)
    assert not differ.any() and [ids[a:b].tolist() for a, b in zip(until, until[1:])] == processor.encode(texts)


def test_a_hot_id_is_dealt_over_tasks(spark, docs_of):
    """A third of all rows have one doc_id, others none: their order is that of the text hash, and no task has them all."""
    rows = [(7, f"hot row {k} " * 30) for k in range(300)] + [(None, f"none {k}") for k in range(100)] + [(k, f"row {k}") for k in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokens = token_io.write_tokens(docs_of(rows).repartition(4), BYTES, block_ids=400)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = token_io.read_tokens(tokens).collect()
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BYTES)
    want = sorted(([*tokenizer.encode(t).ids, 0] for i, t in rows if i == 7))
    hot = sorted((r for r in got if r.doc_id == 7), key=lambda r: r.start)
    assert sorted(r.ids for r in hot) == want and all(a.start + a.n_tokens == b.start for a, b in zip(hot, hot[1:]))
    assert [r.start for r in got if r.doc_id is None] and max(r.start for r in got if r.doc_id is None) < min(r.start for r in got if r.doc_id is not None)
    shards = tokens.selectExpr("shard", "explode(doc_ids) AS d").filter("d = 7").select("shard").distinct().count()
    assert shards > 1


def test_base_statistics(spark, docs_of, small):
    for rows in (small, EDGES):
        got = quality_rules.judge(docs_of(rows)).collect()
        assert len(got) == len(rows)
        want = {i: brute.base_statistics(t) for i, t in rows}
        for r in got:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id], r.doc_id
            assert r.kept == (not r.base_failed and r.probability >= quality_rules.KEEP)
    assert quality_rules.judge(docs_of([])).count() == 0


def test_base_spans(docs_of, small):
    random.seed(11)
    noise = [(1000 + k, "".join(random.choice("0123456789 -.+()@a.b1 \n") for _ in range(400))) for k in range(300)]
    for rows in (small, EDGES + noise, []):
        for r in pii.summary(pii.find_spans(docs_of(rows))).collect():
            text = next(t for i, t in rows if i == r.doc_id)
            spans = brute.base_spans(text)
            n = {k: sum(s[0] == k for s in spans) for k in pii.BASE}
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii.BASE), text
            assert r.base_sha256 == hashlib.sha256(brute.listed(spans).encode()).hexdigest()
            assert r.spans.startswith(brute.listed(spans))


def test_added_spans_need_check_and_context(docs_of):
    rows = [(1, EDGES[10][1]), (2, "my amex card 3782 822463 10005 here"), (3, "number 3782 822463 10005 here"),
            (4, "social security 123-45-6789"), (5, "code 123-45-6789"), (6, "phone (212) 555-0123"), (7, "ratio (212) 555-0123")]
    got = {r.doc_id: r.spans for r in pii.summary(pii.find_spans(docs_of(rows))).collect()}
    assert got[1] == "iban:0:27"
    assert got[2].startswith("short_card:") and got[3] == ""
    assert got[4].startswith("national_id:") and got[5] == ""
    assert got[6].startswith("local_phone:") and got[7] == ""
    # the words beside a span set its score: the same number with and without them
    near = [(1, f"card {CARD}"), (2, f"code {CARD}"), (3, "none")]
    scores = {r.doc_id: r.scores for r in pii.summary(pii.find_spans(docs_of(near))).collect()}
    assert int(scores[1]) > int(scores[2]) and scores[3] == ""


def test_account_numbers_before_words_and_digits(docs_of):
    numbers = ["AT61 1904 3002 3457 3201", "BE68539007547034", "BE68 5390 0754 7034", "SE45 5000 0000 0583 9825 7466", "GB82 WEST 1234 5698 7654 32",
               "NO93 8601 1117 947", "PL61 1090 1014 0000 0712 1981 2874", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "DE89370400440532013000"]
    after = [" BIC: BKAUATWW", " EUR 50", " 2024", " 50 EUR", " A1", " BE68 5390 0754 7034", ", x", ""]
    cases = [(f"IBAN {n}{a}", [n, *([a[1:]] if a == after[5] else [])]) for n in numbers for a in after]
    cases += [("order QX12 3456 7890 AT61 1904 3002 3457 3201", [numbers[0]]), ("IBAN AT61 1904 3002 3457 320 BIC", []), ("account QX33 1234 5678 90 x", [])]
    rows = [(k, text) for k, (text, _) in enumerate(cases)]
    for r in pii.find_spans(docs_of(rows)).collect():
        text, want = cases[r.doc_id]
        got = [s for s in r.spans if s.kind == "iban"]
        assert [s.value for s in got] == want and all(text[s.start:s.end] == s.value for s in got), text


def test_many_matches_in_one_text(docs_of):
    text = " ".join(f"u{k}@h.org" for k in range(3000))
    spans = pii.find_spans(docs_of([(1, text)])).first().spans
    assert [(s.start, s.end) for s in spans] == [(a, b) for _, a, b in brute.base_spans(text)]


def test_line_dedup(spark, docs_of, small):
    passage = "\n".join(f"line {k} of a passage that many share" for k in range(9))
    one = " ".join(f"w{k}" for k in range(60))
    shared = [(20 + k, f"own {k}\n\n{passage}\nend {k}") for k in range(5)] + [(30 + k, f"{one}\nown {k}") for k in range(3)]
    twice = [(40, f"{passage}\nbetween\n{passage}"), (None, passage), (41, passage), (41, one)]
    for rows in (small, EDGES + shared + twice, []):
        got, made = line_dedup.dedup_lines(docs_of(rows), 50)
        got = [((r.doc_id, r.text), r[made].n_deleted) for r in got.collect()]
        plain = brute.dedup_lines(rows, 50)
        want = [((i, plain[i, t][0]), plain[i, t][1]) for i, t in rows]
        assert sorted(got, key=str) == sorted(want, key=str)


def whole_runs(rows, min_words):
    """{(doc_id, text): text left} when every line of a run of ``min_words`` words or more that occurred before goes:
    all pairs of places, each match extended to its end."""
    order = sorted(set(rows), key=lambda r: r[0])
    words = [[(k, x.split()) for k, x in enumerate(t.split("\n")) if x.split()] for _, t in order]
    out = {}
    for d, own in enumerate(words):
        drop = set()
        for e in range(d + 1):
            for i in range(len(own)):
                for k in range(i if e == d else len(words[e])):
                    n = 0
                    while i + n < len(own) and k + n < len(words[e]) and own[i + n][1] == words[e][k + n][1]:
                        n += 1
                    if sum(len(w) for _, w in own[i:i + n]) >= min_words:
                        drop.update(range(own[i][0], own[i + n - 1][0] + 1))
        out[order[d]] = "\n".join(x for k, x in enumerate(order[d][1].split("\n")) if k not in drop)
    return out


def test_line_dedup_whole_runs(docs_of):
    long, short = " ".join(f"w{k}" for k in range(60)), " ".join(f"t{k}" for k in range(10))
    rows = [(1, f"{long}\n{short}"), (2, f"{long}\n\n{short}"), (3, f"{short}\n{long}\n{short}\nown"), (4, f"own\n{short}"), (4, f"own\n{short}")]
    got, _ = line_dedup.dedup_lines(docs_of(rows), 50)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, rows[0][1]), (2, ""), (3, f"{short}\nown"), (4, rows[3][1]), (4, rows[4][1])]
    random.seed(7)
    lines = [" ".join(f"{c}{k}" for k in range(random.randint(1, 12))) for c in "abcde"]
    rows = [(k, "\n".join(random.choice(["", *lines]) for _ in range(random.randint(1, 25)))) for k in range(60)]
    got, _ = line_dedup.dedup_lines(docs_of(rows), 20)
    want = {(i, t) for (i, _), t in whole_runs(rows, 20).items()}
    assert {(r.doc_id, r.text) for r in got.collect()} == want == {(i, t) for (i, _), (t, _) in brute.dedup_lines(rows, 20).items()}


def test_later_exact_copies_become_empty(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    first = {}
    for i, t in sorted(docs):
        first.setdefault(t, i)
    got, _ = line_dedup.dedup_lines(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text"), 50)
    left = {r.doc_id: r.text for r in got.collect()}
    copies = [i for i, t in docs if first[t] != i and len(t.split()) >= 50]
    assert len(copies) > 50 and [i for i in copies if left[i]] == []


def test_line_dedup_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "x", 5, [1])], "doc_id long, text string, _line_runs int, fp array<int>")
    got, made = line_dedup.dedup_lines(docs)
    assert got.drop(made).collect() == docs.collect()


def near_copies():
    random.seed(2)
    base = [f"w{random.randint(0, 500)}" for _ in range(400)]
    out = [(200, " ".join(base))]
    for k in range(60):
        copy = list(base)
        for _ in range(k % 7):
            copy[random.randrange(400)] = f"z{random.randint(0, 99)}"
        out.append((300 + k, " ".join(copy)))
    return out


def test_near_duplicates(docs_of, small):
    for rows in (small, EDGES + near_copies(), []):
        assert rows_of(simhash_index.near_duplicates(docs_of(rows))) == sorted(brute.near_duplicates(rows), key=str)


def test_near_duplicates_in_tiles(docs_of, monkeypatch):
    monkeypatch.setattr(simhash_index, "SPLIT", 3)
    rows = EDGES + near_copies()
    assert rows_of(simhash_index.near_duplicates(docs_of(rows))) == sorted(brute.near_duplicates(rows), key=str)


@pytest.mark.parametrize("agree", [1, 2, 3])
def test_near_duplicates_by_choices_of_blocks(docs_of, monkeypatch, agree):
    monkeypatch.setattr(simhash_index, "agreeing_blocks", lambda n, bits: agree)
    rows = EDGES + near_copies()
    assert rows_of(simhash_index.near_duplicates(docs_of(rows))) == sorted(brute.near_duplicates(rows), key=str)


def test_index_rows_per_fingerprint(spark):
    """Keys get longer with the number of fingerprints, so that groups stay small and a fingerprint has a row per key."""
    assert [simhash_index.agreeing_blocks(n, 4) for n in (0, 10**5, 10**6, 3 * 10**6, 10**8, 10**9, 10**11)] == [1, 1, 1, 2, 2, 3, 4]
    for n, keys in ((10**5, 5), (3 * 10**6, 15)):
        fps = spark.range(n).select(F.xxhash64("id").alias("fp"))
        rows = simhash_index._tiles(simhash_index._keys(fps, 4, simhash_index.agreeing_blocks(n, 4))).count()
        assert keys * n <= rows < 1.5 * keys * n


def test_keys_are_fingerprints_turned(spark):
    import itertools
    fps = [0x0123456789ABCDEF, -1, 1 << 62, 0]
    got = simhash_index._keys(spark.createDataFrame([(f,) for f in fps], "fp long"), 4, 2).collect()
    blocks, pairs = simhash_index._blocks(6), list(itertools.combinations(range(6), 2))
    assert len(got) == len(fps) * len(pairs) and sum(w for _, w in blocks) == 64
    for r in got:
        value = 0
        for b in pairs[r.block]:
            shift, width = blocks[b]
            value = value << width | (r.fp % 2**64) >> shift & (1 << width) - 1
        assert r.value == value


def test_null_ids_link(docs_of):
    got = rows_of(simhash_index.near_duplicates(docs_of([(None, "a b c d e"), (7, "a b c d e"), (None, "other words are here now")])).select(
        "doc_id", "component_id"))
    assert got == sorted([(None, 7), (7, 7), (None, None)], key=str)


def test_one_per_group(docs_of):
    rows = EDGES + near_copies() + [(None, "lonely text without id here")]
    kept = [(r.doc_id, r.text) for r in simhash_index.one_per_group(docs_of(rows)).collect()]
    groups = {c for _, _, c in brute.near_duplicates([r for r in rows if r[0] is not None])}
    assert sorted(i for i, _ in kept if i is not None) == sorted(groups) and len(kept) == len(groups) + 1


def test_stars_on_a_long_chain(spark):
    n = 200
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(order[k], order[k + 1]) for k in range(n - 1)] + [(500, 501)], "a long, b long")
    got = {(r.v, r.root) for r in simhash_index.stars(links).collect()}
    assert got == {(v, 0) for v in range(1, n)} | {(501, 500)}
    assert simhash_index.stars(links.limit(0)).count() == 0


def test_contamination(spark, docs_of, small):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    schema = "item_id long, text string"
    ten = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    own = [(900, ten), (901, ten + " lambda"), (902, "Short-item"), (903, None), (904, ""), (905, ten), (906, "the the the the the the the the the the")]
    rows = EDGES + [(50, f"before {ten.upper()}, lambda after"), (51, "a short item, a short?item"), (52, ten[:-5]), (53, "the " * 12)]
    for docs, bench in ((small, items), (rows, own), ([], own), (rows, [])):
        got = decontaminate.contamination(docs_of(docs), spark.createDataFrame(bench, schema))
        assert rows_of(got) == sorted(brute.contamination(docs, bench), key=str)


def test_index_shards_and_benchmark_blocks(spark, docs_of, small, monkeypatch):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = rows_of(decontaminate.contamination(docs_of(small), items))
    blocks = decontaminate.item_blocks
    monkeypatch.setattr(decontaminate, "item_blocks", lambda b: blocks(b, block_bytes=500))
    index = decontaminate.build_index
    monkeypatch.setattr(decontaminate, "build_index", lambda d: index(d, shard_tokens=700))
    assert len(list(decontaminate.item_blocks(items))) > 1
    assert rows_of(decontaminate.contamination(docs_of(small), items)) == whole


def near_matches(rows, phrase, slop):
    """{(doc_id, start)}: every start for which each term is within ``slop`` of its place, least displacement of a row of starts."""
    out = set()
    for doc, text in rows:
        w = text.lower().split()
        good = {}
        for s in range(-len(phrase) - slop, len(w) + slop + 1):
            apart = [min((abs(p - s - k) for p, x in enumerate(w) if x == t), default=slop + 1) for k, t in enumerate(phrase)]
            if max(apart) <= slop:
                good[s] = sum(apart)
        for s in sorted(good):
            if s - 1 not in good:
                run = [s]
                while run[-1] + 1 in good:
                    run.append(run[-1] + 1)
                out.add((doc, min(run, key=lambda x: (good[x], x))))
    return out


def test_proximity_matches(spark, docs_of):
    rows = [(1, "x alpha beta gamma y"), (2, "alpha z beta gamma"), (3, "gamma alpha"), (4, "alpha b c d beta gamma"),
            (5, "alpha z beta z gamma"), (6, "alpha gamma alpha gamma"), (7, "beta gamma"), (8, "alpha"), (9, "gamma beta alpha")]
    random.seed(12)
    rows += [(100 + k, " ".join(random.choice(["alpha", "beta", "gamma", "z", "z"]) for _ in range(random.randrange(1, 12)))) for k in range(120)]
    bench = spark.createDataFrame([(7, "Alpha beta gamma")], "item_id long, text string")
    phrase = ["alpha", "beta", "gamma"]
    for tokens in (1, 40, 10**6):                      # the result does not depend on the shards
        index = decontaminate.build_index(docs_of(rows).coalesce(2), shard_tokens=tokens)
        exact = {(r.doc_id, r.start) for r in decontaminate.matches(index, bench).collect()}
        assert exact == near_matches(rows, phrase, 0) and (1, 1) in exact
        for slop in (1, 2):
            got = [(r.doc_id, r.start) for r in decontaminate.matches(index, bench, slop=slop).collect()]
            assert len(got) == len(set(got)) and set(got) == near_matches(rows, phrase, slop)


def test_registered_over_whole_tables(spark):
    n_docs = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    n_pages = spark.read.parquet(f"{SMALL}/pages.parquet").count()
    for name, query in queries().items():
        if not name.startswith(("op11_", "op13_")):  # see test_vectors
            assert query(spark, SMALL).count() == (n_pages if name.startswith("op2_") else n_docs), name
