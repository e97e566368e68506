"""Operators against brute force, exact round trips, other libraries, and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from larder.llm import (
    decontaminate,
    language,
    packing,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    suffixes,
    token_counts,
    tokens,
    wavelet,
)
from larder.llm.components import connected_components
from larder.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {row.doc_id: row.text or "" for row in docs.collect()}


# ---------------------------------------------------------------- near-duplicates


def slow_fingerprint(text):
    words = [w for w in re.split(r"[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    if not words:
        return 0
    shingles = [words] if len(words) < 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(nodes, linked):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_simhash_query(spark, texts):
    prints = {i: slow_fingerprint(text) for i, text in texts.items()}
    ids = sorted(prints)
    linked = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = {i: (f"{prints[i]:016x}", root) for i, root in groups_of(ids, linked).items()}
    found = QUERIES["op1_simhash"].run(spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected
    assert len(found) == len(texts)


@pytest.mark.parametrize("blocks", [5, 7, 9])
def test_close_pairs_once_each(spark, blocks):
    pick = random.Random(blocks)
    centres = [pick.getrandbits(64) for _ in range(20)]
    values = {c ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 6))) for c in centres for _ in range(12)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    expected = sorted(
        (a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    )
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    assert sorted(map(tuple, simhash.close_pairs(frame, 4, blocks).collect())) == expected


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (1, 2), (2, 1), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    expected = {**{i: 100 for i in range(101, 141)}, **{i: 7 for i in range(200, 260)}, 2: 1}
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)


def test_one_document_of_each_group_stays(spark, docs):
    ids = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.deduplicate(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(ids)


# ---------------------------------------------------------------- quality model, language


def held_out(ids, divisor):
    return {i: zlib.crc32(str(i).encode()) % divisor for i in ids}


def test_quality_model_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["op2_quality_model"].run(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rest = held_out(found, 5)
    assert all(r.held_out == (rest[i] == 0) and r.predicted == int(r.score >= 0.3) for i, r in found.items())
    judged = [(found[i].predicted, label) for i, label in labels.items() if rest[i] == 0]
    assert np.mean([p == label for p, label in judged]) >= 0.9


def test_network_learns_what_a_line_cannot():
    random_ = np.random.default_rng(3)
    x = random_.normal(size=(2000, 4)).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    network = quality_model.fit(x, y)
    assert ((network.probability(x) >= 0.5) == y).mean() > 0.9
    flat = quality_model.fit(x[:50], np.ones(50, int))
    assert (flat.probability(x) > 0.9).all()


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["op3_language"].run(spark, sf).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rest = held_out(found, 4)
    assert all(r.held_out == (rest[i] == 2) for i, r in found.items())
    assert np.mean([found[i].lang_pred == truth[i] for i in truth if rest[i] == 2]) >= 0.97


def test_forward_backward_sums_over_all_paths():
    random_ = np.random.default_rng(5)
    scores, moves = random_.normal(size=(9, 3)), random_.normal(size=(3, 3))
    ends = np.array([4, 4, 9])
    found, _ = language.forward_backward(scores, ends, moves)
    for begin, end in ((0, 4), (4, 9)):
        total = np.zeros((end - begin, 3))
        for code in range(3 ** (end - begin)):
            path = [code // 3**i % 3 for i in range(end - begin)]
            weight = np.exp(sum(scores[begin + t, s] for t, s in enumerate(path)))
            # The label before the first word is free.
            weight *= sum(np.exp(moves[s, path[0]]) for s in range(3)) * np.exp(
                sum(moves[a, b] for a, b in zip(path, path[1:]))
            )
            for t, s in enumerate(path):
                total[t, s] += weight
        assert np.allclose(total / total.sum(axis=1, keepdims=True), found[begin:end])


def test_blocks_change_nothing(monkeypatch):
    random_ = np.random.default_rng(6)
    scores, moves, ends = random_.normal(size=(300, 4)), random_.normal(size=(4, 4)), np.array([1, 130, 131, 300])
    whole = language.forward_backward(scores, ends, moves)[0]
    monkeypatch.setattr(language, "BLOCK", 7)
    assert np.allclose(language.forward_backward(scores, ends, moves)[0], whole)


def test_code_switched_words(docs):
    rows = docs.where("lang IN ('en', 'de')").collect()
    field = language.fit([r.text for r in rows], [r.lang for r in rows])
    en = next(r.text for r in rows if r.lang == "en" and len(r.text.split()) > 60).split()[:40]
    de = next(r.text for r in rows if r.lang == "de" and len(r.text.split()) > 60).split()[:40]
    tagged = [lang for _, lang, _ in language.tag(field, " ".join(en + de))]
    assert np.mean([a == b for a, b in zip(tagged, ["en"] * 40 + ["de"] * 40)]) > 0.85


# ---------------------------------------------------------------- decontamination


def test_decontamination_query(spark):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    cursor = duck.execute(QUERIES["op4_decontaminate"].sql)
    names = [c[0] for c in cursor.description]
    found = QUERIES["op4_decontaminate"].run(spark, SF_DIR)
    assert set(found.columns) == set(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(cursor.fetchall())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def slow_hits(text, items, window):
    split = lambda t: [w for w in re.split(r"[\x00-/:-`{-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    words, hit, seen = split(text), set(), set()
    for item, body in items:
        own = split(body)
        n = min(window, len(own))
        runs = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i : i + n]) in runs:
                hit.update(range(i, i + n))
                seen.add(str(item))
    return len(words), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()


@pytest.mark.parametrize("broadcast_grams", [0, 1000])
def test_windows_of_all_lengths(spark, broadcast_grams):
    pick = random.Random(9)
    some = lambda n: " ".join(pick.choice(["a", "B", "é", "É", "7", "x-y", "K"]) for _ in range(n))
    items = [(i, some(pick.randint(0, 9))) for i in range(40)] + [(3, "b a b a"), (99, None)]
    rows = [(i, some(pick.randint(0, 40))) for i in range(60)] + [(60, None), (5, "a b a")]
    found = decontaminate.contamination(
        spark.createDataFrame(rows, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
        window=5,
        broadcast_grams=broadcast_grams,
    )
    got = sorted((r.id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in found.collect())
    assert got == sorted((i, *slow_hits(text, items, 5)) for i, text in rows)


def test_letters_whose_case_depends_on_the_next_word(spark):
    """A capital sigma at the end of a word, before punctuation in the text and before a blank in the item."""
    text = "\u0391\u03a3.b c.\u0394\u03a3'e f"
    item = "\u0391\u03a3 b c \u0394\u03a3 e f"
    found = decontaminate.contamination(
        spark.createDataFrame([(1, text), (2, text.lower())], "doc_id bigint, text string"),
        spark.createDataFrame([(7, item)], "item_id bigint, text string"),
    ).collect()
    assert {r.id: (r.n_words, r.n_hit) for r in found} == {1: (6, 6), 2: (6, 0)}


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "Keep, this A b-c D e? and (that)."), (2, "a b c d e"), (3, "clean.")], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "a b c d e")], "item_id int, text string")
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, window=5, remove="spans").collect()}
    assert cut == {1: "Keep, this and (that).", 2: "", 3: "clean."}
    assert [r.doc_id for r in decontaminate.decontaminate(docs, bench, window=5).collect()] == [3]


# ---------------------------------------------------------------- repeated passages


def slow_passages(rows, size):
    seen, out = defaultdict(set), []
    for n, (_, text) in enumerate(rows):
        words = (text or "").encode().split()
        for i in range(len(words) - size + 1):
            seen[tuple(words[i : i + size])].add(n)
    for doc, text in rows:
        words = (text or "").encode().split()
        covered = [False] * (len(words) + 1)
        for i in range(len(words) - size + 1):
            if len(seen[tuple(words[i : i + size])]) > 1:
                covered[i : i + size] = [True] * size
        spans, start = [], None
        for i, on in enumerate(covered):
            if on and start is None:
                start = i
            elif not on and start is not None:
                spans.append(f"{start}:{i}")
                start = None
        if spans:
            out.append((doc, len(words), sum(covered), ",".join(spans)))
    return sorted(out)


@pytest.mark.parametrize("size", [1, 2, 5, 8])
def test_passages_by_brute_force(spark, size):
    pick = random.Random(size)
    rows = [(i, " ".join(pick.choice("abcde") for _ in range(pick.randint(0, 60)))) for i in range(40)]
    rows += [(40, rows[3][1]), (41, None), rows[5]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(map(tuple, suffixes.repeated_passages(frame, passage=size).collect()))
    assert found == slow_passages(rows, size)


def slow_without_repeats(rows, size):
    """Runs in order of id and position; whatever is not the first of its kind is cut, but not over that one."""
    first, out = {}, []
    for doc, text in rows:
        words = (text or "").split()
        cut = set()
        for i in range(len(words) - size + 1):
            in_doc, at = first.setdefault(tuple(words[i : i + size]), (doc, i))
            if (in_doc, at) != (doc, i):
                cut.update(range(max(i, at + size) if in_doc == doc else i, i + size))
        out.append((doc, None if text is None else " ".join(w for i, w in enumerate(words) if i not in cut)))
    return out


@pytest.mark.parametrize("size", [1, 2, 5, 8])
def test_first_copies_stay_by_brute_force(spark, size):
    pick = random.Random(size)
    rows = [(i, " ".join(pick.choice("abcde") for _ in range(pick.randint(0, 60)))) for i in range(40)]
    rows += [(40, rows[3][1]), (41, None), (42, "x " * 29 + "x"), (43, "p q r s t u v w y z " * 3 + "end")]
    frame = spark.createDataFrame(rows[::-1], "doc_id bigint, text string").repartition(3)
    found = sorted(map(tuple, suffixes.without_repeats(frame, passage=size).collect()))
    assert found == [(i, t.strip() if t else t) for i, t in slow_without_repeats(rows, size)]


def test_repeats_inside_one_text_are_cut(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"a {words} b\n{words}  c", "x"), (1, f"a {words} b\n{words}  c", "x"), (2, f"{words}\nnew", "y"), (3, "", None)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, other string")
    cleaned = suffixes.without_repeats(frame)
    assert cleaned.columns == frame.columns
    found = sorted(map(tuple, cleaned.select("doc_id", "text").collect()))
    assert found == [(1, ""), (1, f"a {words} b\nc"), (2, "new"), (3, "")]
    assert suffixes.without_repeats(frame.limit(0)).collect() == []


def test_passages_query(spark, texts):
    found = sorted(map(tuple, QUERIES["op5_repeated_passages"].run(spark, SF_DIR).collect()))
    assert found == slow_passages(sorted(texts.items()), 50)


# ---------------------------------------------------------------- tokens


def tokenizer():
    it = Tokenizer.from_file(tokens.default_tokenizer())
    it.encode_special_tokens = True
    return it


def test_encoder_equals_the_tokenizer():
    pick, encoder, exact = random.Random(2), tokens.TextEncoder(tokens.default_tokenizer()), tokenizer()
    letters = ["a", "the", " ", "  ", "\n", "\t", "é", "中", "😀", "'s", "'", "9", ".", "!?", " ", "<|endoftext|>", "\r\n", "　"]
    texts = ["".join(pick.choice(letters) for _ in range(pick.randint(0, 12))) for _ in range(6000)] + [None]
    expected = [np.array(exact.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == expected


def test_encoder_that_remembers_little(texts, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", 50)
    encoder, exact = tokens.TextEncoder(tokens.default_tokenizer()), tokenizer()
    some = list(texts.values())[:30]
    expected = [np.array(exact.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
    assert encoder.encode(some) == expected


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (63, 2), (64, 60000), (65, 50256), (3000, 7), (5000, 2**20)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype("<u4")
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(ids).to_bytes())
    assert (matrix.ids() == ids).all() and len(matrix.ids()) == n
    where = defaultdict(list)
    for i, value in enumerate(ids.tolist()):
        where[value].append(i)
    for i in range(0, n, max(1, n // 50)):
        assert matrix.access(i) == ids[i]
    for value in list(where)[:20]:
        assert matrix.occurrences(value) == where[value]
        assert matrix.count(value, n // 3, n // 2) == sum(n // 3 <= i < n // 2 for i in where[value])
    assert matrix.count(top + 1) == 0


def test_token_files_query(spark, texts):
    exact, start, expected = tokenizer(), 0, {}
    for i in sorted(texts):
        ids = exact.encode(texts[i], add_special_tokens=False).ids + [2]
        expected[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = QUERIES["op6_token_files"].run(spark, SF_DIR).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == expected


def test_small_blocks(spark, docs, tmp_path):
    one = wavelet.tokenized(docs).collect()
    wavelet.write_tokens(docs, str(tmp_path / "t"), block_tokens=700)
    assert spark.read.parquet(str(tmp_path / "t")).count() > 100
    assert sorted(wavelet.read_tokens(spark, str(tmp_path / "t")).collect()) == sorted(one)


def test_packing_query(spark, texts):
    exact = tokenizer()
    ids = {i: exact.encode(text, add_special_tokens=False).ids + [0] for i, text in texts.items()}
    rows = QUERIES["op7_packing"].run(spark, SF_DIR).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert (len(part), r.doc_tokens) == (r.length, len(ids[r.doc_id]))
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for key, parts, size in [(i, by_doc[i], len(ids[i])) for i in ids] + [(s, p, None) for s, p in by_sequence.items()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0, key
            at += length
        assert at == size if size else at <= 1024
    total = sum(map(len, ids.values()))
    assert sorted(by_sequence) == list(range(-(-total // 1024)))


def test_sequences_are_filled(spark, docs):
    pieces = packing.packed(docs)
    rows = sorted(packing.sequences(pieces, pad_id=9).collect())
    assert all(r.n_tokens == 1024 and len(r.ids) == 4096 for r in rows[:-1])
    last = rows[-1]
    assert len(last.ids) == (4 * last.n_tokens if last.n_tokens.bit_count() == 1 else 4096)


def test_count_only_viterbi_equals_the_tokenizer(texts):
    vocabulary = token_counts.read_vocabulary(token_counts.default_vocabulary())
    exact = Tokenizer(models.Unigram(list(vocabulary.pieces), vocabulary.unknown, True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always")
    pick = random.Random(4)
    letters = list("abe. \n\t▁éß中😀sthing ''") + ["<0x41>", "the", "  "]
    odd = ["".join(pick.choice(letters) for _ in range(pick.randint(0, 14))) for _ in range(4000)]
    counter = token_counts.Counter(vocabulary)
    for text in [*odd, *list(texts.values())[:60]]:
        assert counter.text(text) == len(exact.encode(text, add_special_tokens=False).ids), text


def test_viterbi_ties_and_unknown_characters():
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("ba", -2.0), ("aba", -3.0), ("c", -4.0)]
    exact = Tokenizer(models.Unigram(pieces, 0, False))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always")
    counter = token_counts.Counter(token_counts.Vocabulary(tuple(pieces), 0, False))
    pick = random.Random(8)
    for _ in range(5000):
        text = "".join(pick.choice("abcde ") for _ in range(pick.randint(0, 9)))
        assert counter.text(text) == len(exact.encode(text, add_special_tokens=False).ids), text


def test_token_counts_query(spark, texts):
    counter = token_counts.Counter(token_counts.read_vocabulary(token_counts.default_vocabulary()))
    found = QUERIES["op8_token_counts"].run(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_chars, r.n_tokens) for r in found} == {i: (len(t), counter.text(t)) for i, t in texts.items()}


# ---------------------------------------------------------------- quality rules


def slow_base(text):
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    lines = [line for line in text.split("\n") if re.search(r"[^ \t-\r]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(hit),
    )


def test_quality_rules_query(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op9_quality_rules"].run(spark, SF_DIR).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        r, base = found[i], slow_base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r.base_failed and r.kept)


def test_repeated_words_at_random():
    pick = random.Random(1)
    for _ in range(500):
        words = [pick.choice("abc") for _ in range(pick.randint(0, 12))]
        assert quality_rules.repeat_words(words) == slow_base(" ".join(words))[4]


def test_votes_are_weighed(spark):
    """Against known accuracies, and against the labels: good documents stay, junk goes."""
    random_ = np.random.default_rng(12)
    truth = random_.random(4000) < 0.8
    flip = random_.random((4000, 6)) < np.array([0.05, 0.1, 0.1, 0.2, 0.3, 0.4])
    votes = np.where(random_.random((4000, 6)) < 0.2, 2, (truth[:, None] ^ flip).astype(int))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.fit_votes(patterns, counts.astype(float))
    assert ((model.log_odds(votes) > 0) == truth).mean() > 0.93
    assert model.votes[1, 0, 1] > model.votes[1, 5, 1]

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL")
    judged = QUERIES["op9_quality_rules"].run(spark, sf).drop("quality").join(labels, "doc_id").collect()
    assert np.mean([r.kept for r in judged if r.quality == 1 and not r.base_failed]) > 0.98
    assert np.mean([not r.kept for r in judged if r.quality == 0]) > 0.9


# ---------------------------------------------------------------- secrets


def test_base_patterns():
    text = 'PASSWORD = "abc123" token:abc x Api_Key=\'k9/+=.-_\' AKIA' + "A1" * 8 + " AKIAX deadbeef" + "0" * 16 + " token=token:abcdefg"
    assert [str(s) for s in secrets.base_spans(text)] == [
        "assign:0:18",
        "assign:32:49",
        "access:51:71",
        "hex:78:102",
    ]
    assert secrets.base_spans("\u017fecret=abcdefgh to\u212aen=abcdefgh") == []


def test_guess_costs_grow_with_surprise():
    cheap = ["password", "Password1", "qwertyuiop", "2019-10-12", "aaaaaaaaaaaa", "abcdefgh", "summer2020", "P@ssw0rd", "changeme"]
    dear = ["x9$kQ!z7Lp#w", "tr7Gq0Zb!kVw2", "correct horse battery staple"]
    assert max(map(secrets.guess_bits, cheap)) < 30 < secrets.GUESS_BITS <= min(map(secrets.guess_bits, dear))
    assert secrets.guess_bits("") == 0.0
    assert secrets.guess_bits("kV9!kV9!kV9!") < secrets.guess_bits("kV9!pQ3#zR7?")


def test_long_repeats_cost_time_in_proportion():
    """A value of 200,000 characters made of one pair: quadratic work would take hours."""
    value = "x9" * 100_000
    assert secrets.guess_bits(value) < secrets.GUESS_BITS
    assert [str(s) for s in secrets.guess_spans(f"pwd: {value}", [])] == []


def test_guesses_are_added_to_the_base():
    text = "pwd: 'x9$kQ!z7Lp#w' and passphrase = changeme1 and password=abcdef1234567890"
    base = secrets.base_spans(text)
    more = secrets.guess_spans(text, base)
    assert [str(s) for s in more] == ["guess:6:18"]
    assert secrets.redact(text, secrets.in_order([*base, *more]), "*") == "pwd: '*' and passphrase = changeme1 and *"


@pytest.mark.parametrize("size", [8, 9, 10, 12])
@pytest.mark.parametrize("context", ["pwd: {}", "db_pwd={}", "myCredentials: '{}'", "xauth_key => {}"])
def test_random_values_outside_the_base_keys(size, context):
    pick = random.Random(size)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for alphabet in (letters + "0123456789", letters + letters.upper() + "0123456789", letters.upper() + letters + "!#$%&*+?"):
        texts = [context.format("".join(pick.choices(alphabet, k=size))) for _ in range(50)]
        assert sum(len(secrets.guess_spans(text, secrets.base_spans(text))) == 1 for text in texts) >= 48


def test_values_within_the_guess_budget_of_mixed_classes():
    for text in ('pwd: "xK9mQ2vT"', "pwd=xK9mQ2vTb7", "password: !Xy7#pQ2"):
        (span,) = secrets.guess_spans(text, secrets.base_spans(text))
        assert text[span.start : span.end] == re.split(r"[:=] ?", text)[1].strip('"')
    assert secrets.guess_spans("pwd: 83920174 pwd: Password12 pwd: aaaaaaaaaaaa", []) == []


def test_words_of_the_corpus_are_no_secrets(spark):
    """Ranks come from all texts; what follows a credential context does not count."""
    prose = "the terms must be at least as international as a configuration that users get by value"
    rows = [(i, prose) for i in range(30)] + [(i, "must be at least the terms in characters eight") for i in range(30, 60)]
    rows += [(i, "pwd: kqxzvbrtjw") for i in range(60, 80)]
    values = ["credentials: international", 'Password: "must be at least eight characters"', "access_key = configuration.get_value"]
    rows += list(enumerate(values + ['passphrase: "kqx zvbrt jwpl mfgh"', "credentials: unheardofletters"], 80))
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    ranks = {r.word: r["rank"] for r in secrets.word_ranks(frame).collect()}
    assert ranks["must"] == ranks["least"] == 1 and ranks["international"] > ranks["must"]
    assert not {"kqxzvbrtjw", "unheardofletters"} & set(ranks)
    found = {r.id: r.spans for r in secrets.scan(frame).collect()}
    assert sorted(i for i in found if found[i]) == [*range(60, 80), 83, 84]
    cleaned = {r.doc_id: r.text for r in secrets.without_secrets(frame).collect()}
    assert [cleaned[80 + i] for i in range(3)] == values and cleaned[60] == "pwd: [secret]"


def test_no_word_of_the_corpus_is_lost(spark):
    """Ranks of all words in enough texts, of any length, alike where counts are."""
    long = "donau" * 30
    rows = [(i, "and the") for i in range(9)] + [(i, f"rare {long}") for i in range(6)] + [(i, "other") for i in range(6)]
    rows += [(i, "few") for i in range(4)] + [(9, "credentials: rare-thing")]
    ranks = {r.word: r["rank"] for r in secrets.word_ranks(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert ranks["rare"] == ranks["other"] == ranks[long] == 3 and ranks["the"] == ranks["and"] == 1
    assert "few" not in ranks and "thing" not in ranks and ranks["letmein"] == secrets.WORDS.index("letmein") + 1


def test_copies_of_any_length():
    pick = random.Random(7)
    unit = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=17))
    once = secrets.guess_bits(unit)
    assert secrets.guess_bits("!" + unit * 2) < once + 35
    assert secrets.guess_bits(unit * 50) < once + 35


def test_secrets_query(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op10_secrets"].run(spark, SF_DIR).collect()}
    assign = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for i, text in texts.items():
        base = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        listed = [f"{secrets.KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(base)]
        r = found[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in base) for kind in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) or not listed


# ---------------------------------------------------------------- pipeline


@pytest.mark.parametrize("planted", [False, True])
def test_pipeline_by_brute_force(spark, docs, texts, tmp_path, planted):
    """The given documents; and those with secrets, odd texts and repeated rows among them."""
    sf_dir = SF_DIR
    if planted:
        sf_dir, words = str(tmp_path), "the of and word some text good long line more"
        texts = dict(texts)
        values = ["xK9mQ2vTb7", "the-of-and-word", '"qT7 zzkw vrq jjx wp"', "password123"]
        texts |= {9000 + i: f"{texts[i]} pwd: {values[i % 4]} and {words}" for i in range(0, 60, 3)}
        texts |= {9100: None, 9101: "", 9102: " \n ", 9103: " ".join(texts[i] for i in range(40))}
        rows = [(i, t, "en", "src", 7) for i, t in texts.items()] + [(9000, texts[9000], "en", "src", 7)] * 2
        spark.createDataFrame(rows, docs.schema).write.parquet(f"{sf_dir}/documents.parquet")
        spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(f"{sf_dir}/benchmark.parquet")
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = {r.id: r.kept for r in quality_rules.judge(out).collect()}
    kept = {i: t for i, t in texts.items() if judged[i]}
    prints = {i: slow_fingerprint(t) for i, t in kept.items()}
    linked = [(a, b) for a in kept for b in kept if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    kept = {i: kept[i] for i, root in groups_of(kept, linked).items() if i == root}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    counts = {i: slow_hits(t, items, 13) for i, t in kept.items()}
    kept = {i: t for i, t in kept.items() if not (counts[i][1] and 20 * counts[i][1] >= counts[i][0])}
    exact = tokenizer()
    ranked = secrets.word_ranks(spark.createDataFrame([(t,) for t in kept.values()], "text string"))
    ranks = {r.word: r["rank"] for r in ranked.collect()}

    def clean(text):
        base = secrets.base_spans(text)
        guesses = secrets.guess_spans(text, base, ranks=ranks)
        found_guesses.extend(guesses)
        return secrets.redact(text, secrets.in_order([*base, *guesses]))

    found_guesses = []
    expected = {i: len(exact.encode(clean(t), add_special_tokens=False).ids) + 1 for i, t in kept.items()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    found = Counter()
    for r in rows:
        found[r.doc_id] += r.length
    assert dict(found) == expected
    assert not planted or found_guesses


def test_columns_between_stages(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(20), SF_DIR)
        assert out.dtypes == docs.dtypes
    changed = corpus_pipeline.secret_values(spark, docs, SF_DIR)
    assert changed.where(F.char_length("text") != F.col("n_chars")).count() == 0
