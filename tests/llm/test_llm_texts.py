"""Quality rules, byte-level BPE, personal data, toxicity: against brute force and known cases."""

import base64
import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import zstandard

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from cases import awkward_texts, frame, prose  # noqa: E402

from airlens.llm import bpe, pii_bootstrap, quality_bands, toxicity  # noqa: E402

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return [w for w in re.split(f"[{SPACES}]+", text) if w]


# --- quality ---

def plain_quality(text):
    words = words_of(text)
    n, seen = len(words), {}
    for k in range(n - 7):
        seen.setdefault(tuple(words[k:k + 8]), []).append(k)
    inside = {j for at in seen.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
    lines, dup = [], 0
    for line in text.split("\n"):
        dup += bool(words_of(line)) and line in lines
        lines.append(line)
    failed = n < 20 or 100 * len(inside) > 30 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed)


def test_quality_matches_brute_force(spark):
    texts = awkward_texts() + [prose(9, 40) + " " + " ".join(["a b c d e f g h i"] * k) for k in (1, 2, 3, 9)]
    docs = frame(spark, texts)
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality_bands.quality_report(docs).collect()}
    ids = [None if k == 3 else k for k in range(len(texts))]
    assert got == {(i, *plain_quality(t or "")) for i, t in zip(ids, texts)}


def test_compression_bands_reject_both_ends():
    rng, packer = random.Random(0), zstandard.ZstdCompressor(level=quality_bands.LEVEL)
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(9)) for _ in range(900))
    dull = " ".join(f"{w} {w} {w} {w} {w} {w} {w}" for w in prose(4, 300).split())
    half = prose(5, 2000, 17000) + " " + dull * 3
    fine = prose(6, 3000, 17000)
    assert [quality_bands.judge(t, packer)[6] for t in (noise, dull, half, fine)] == [False, False, False, True]


def test_quality_filter_keeps_columns_and_empty_tables(spark):
    docs = frame(spark, awkward_texts())
    kept = quality_bands.keep_good(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert quality_bands.keep_good(docs.limit(0)).count() == 0


# --- byte-level BPE ---

@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        v = bpe.Vocabulary(f.read(), public_tokenizers.PATTERN)
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    return v, reference


def test_bpe_equals_tiktoken(vocabulary):
    v, reference = vocabulary
    r = random.Random(3)
    alphabet = list("aab e  \t\n\r\x0b\x1c\x85  　'stllrevm129½Ⅷ日éß😀‍.,!#-_") + ["<|endoftext|>"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(80))) for _ in range(1500)]
    texts += [t or "" for t in awkward_texts()] + ["".join(r.choice("etaoin") for _ in range(n)) for n in (40, 700, 9000)]
    for group in (texts, texts):  # the second time from the cache
        for text, ids in zip(group, v.encode_all(group)):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
            assert v.decode(ids) == text.encode()


def test_long_pieces_merge_alike_in_matrix_and_heap(vocabulary):
    v, _ = vocabulary
    r = random.Random(5)
    for n in (2, 3, 50, 400):
        piece = "".join(r.choice("abcde") for _ in range(n)).encode()
        assert v.merge_heap(piece).tolist() == v.merge_matrix([piece, b"xyz"])[0].tolist()


def test_small_vocabulary_has_overlapping_merges():
    tokens = [bytes([b]) for b in range(256)] + [b"aa", b"aaa", b"ab", b"aab"]
    file = b"\n".join(base64.b64encode(t) + b" " + str(k).encode() for k, t in enumerate(tokens))
    v = bpe.Vocabulary(file, public_tokenizers.PATTERN)
    reference = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    for text in ("aaaaab", "baaab", "aabaabaaaa", "abab aaab", "a" * 33):
        assert np.frombuffer(v.encode_all([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


def test_token_report_and_columns(spark, vocabulary):
    _, reference = vocabulary
    docs = frame(spark, awkward_texts())
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = {tuple(r) for r in bpe.token_report(docs, path, public_tokenizers.PATTERN).collect()}
    expected = set()
    for k, t in enumerate(awkward_texts()):
        ids = reference.encode_ordinary(t or "")
        expected.add((None if k == 3 else k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                      hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == expected
    ranks = bpe.share_rank_file(spark, path)
    both = docs.select("text", bpe.encoded(docs["text"], ranks, public_tokenizers.PATTERN).alias("ids"))
    back = both.select("text", bpe.decoded(both["ids"], ranks, public_tokenizers.PATTERN).alias("raw")).collect()
    assert all(bytes(r.raw) == (r.text or "").encode() for r in back)


# --- personal data ---

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(v // 10 + v % 10 for v in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = "".join(re.findall("[0-9]", m[0]))
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 12 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_match_plain_patterns():
    r = random.Random(6)
    for _ in range(8000):
        text = "".join(r.choice("a1230.@@+-  (4)9%_é") for _ in range(r.randrange(60)))
        assert pii_bootstrap.base_spans(text) == plain_spans(text)


def test_base_spans_are_linear_in_long_runs():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1 " * 100_000, "0" * 5000 + ".0.0.1"):
        pii_bootstrap.find(run)


def test_contexts_discover_unseen_identifiers(spark):
    secrets = [hashlib.sha256(str(k).encode()).hexdigest()[:40] for k in range(12)]
    texts = [f'{prose(k, 30)} token = "{s}" {prose(k + 99, 20)}' for k, s in enumerate(secrets)]
    texts += [prose(500, 10) + ' token = "zz9-81-PLURAL-7" ' + prose(501, 10), "version 3.14159 is no secret", None, ""]
    texts += [f"{prose(900 + k, 5)} 12{k}456 {prose(950 + k, 5)} me{k}@x.org" for k in range(20)]
    docs = frame(spark, texts, list(range(len(texts))))
    got = {r.doc_id: r for r in pii_bootstrap.personal_data(docs).collect()}
    start = texts[12].index("zz9")
    assert got[12].spans == f"secret:{start}:{start + 15}" and got[12].n_added == 1
    assert got[0].n_added == 1 and got[13].spans == "" and got[14].spans == got[15].spans == ""
    names = ("email", "ip", "card", "phone")
    for k, t in enumerate(texts):
        base = ",".join(f"{names[kind]}:{s}:{e}" for s, kind, e in plain_spans(t or ""))
        assert got[k].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[k].spans.split(","))
        if k >= 16:
            assert got[k].spans == base and got[k].n_email == 1
    assert pii_bootstrap.personal_data(docs.limit(0)).count() == 0


def test_slots_of_sure_patterns_take_any_token(spark):
    """Letter-only and short identifiers are found in a slot that secrets fill, not in one that words fill, too."""
    secrets = [hashlib.sha256(str(k).encode()).hexdigest()[:40] for k in range(80)]
    texts = [f'{prose(k, 20)} token = "{s}" {prose(k + 99, 10)}' for k, s in enumerate(secrets[:40])]
    texts += [f"{prose(k, 20)} value is {s} {prose(k + 99, 10)}" for k, s in enumerate(secrets[40:])]
    texts += [f"{prose(k, 10)} value is w{chr(97 + k % 26)}{chr(97 + k // 26)}q {prose(k + 7, 10)}" for k in range(200)]
    planted = ["PLURAL-ALPHA-KEY", "ab-12-XYZ", "q7", "zz9-81-PLURAL-7"]
    texts += [f'{prose(700 + k, 10)} token = "{w}" {prose(800 + k, 10)} {w}' for k, w in enumerate(planted)]
    docs = frame(spark, texts + texts[:3], list(range(len(texts) + 3)))
    got = {r.doc_id: r for r in pii_bootstrap.personal_data(docs).collect()}
    for k, w in enumerate(planted):
        text = texts[280 + k]
        at = text.index(w)
        assert f"secret:{at}:{at + len(w)}" in got[280 + k].spans.split(","), w
    assert [got[k].n_added for k in range(40)] == [1] * 40 == [got[k].n_added for k in (len(texts), 1, 2)] + [1] * 37
    assert sum(got[k].n_added for k in range(80, 280)) == 0


def test_found_spans_go_out_in_small_frames():
    """A batch's spans are not held together: each frame covers a few texts, all of them in order."""
    texts = [f"{prose(k, 400)} me{k}@x.org" for k in range(60)] * 50
    sizes = [(len(f), f) for f in pii_bootstrap._found.func(iter([pd.Series(texts)]))]
    assert sum(n for n, _ in sizes) == len(texts) and len(sizes) >= sum(map(len, texts)) >> 21 > 1
    spans = [b for _, f in sizes for b in f["base"]]
    assert [[tuple(x.values()) for x in b] for b in spans] == [pii_bootstrap.base_spans(t) for t in texts]


def plain_slots(text, before):
    out, last = [], ""
    for m in re.finditer(r"\S+", text):
        word = m[0]
        places = [m.start() + len(word) - len(word.lstrip("\"'([{<"))] if last in before else []
        places += [m.start() + t.start() for t in re.finditer(r"[A-Za-z0-9@._%+:/-]+", word) if t.start()]
        for at in dict.fromkeys(places):
            token = re.compile(r"[A-Za-z0-9@._%+:/-]*").match(text, at)[0]
            a, b = at + len(token) - len(token.lstrip("@._%+:/-")), at + len(token.rstrip("@._%+:/-"))
            if a < b and "://" not in token and pii_bootstrap.left_word(text, a) in before:
                out.append((a, b, pii_bootstrap._key(text[a:b].lower()), pii_bootstrap.contexts(text, a, b)))
        last = re.sub("[0-9]+", "0", word[-64:].rstrip("\"'([{<").lower())
    return out


def test_slots_match_a_plain_search():
    r = random.Random(4)
    texts = ["".join(r.choice("aB9 ('<-:é,漢/@ΣİQ\n") for _ in range(200)) for _ in range(200)]
    texts += ["", " ab 12", "x" * 200 + "9( q1", "z" * 64 + " q1 " + "z" * 65 + "12 q2\x1cq3\x85q4", "foo( (ab1 x='--a:// b"]
    texts += [" ".join("(" * k + "ab9 " for k in range(60, 70))] + [t for t in awkward_texts() if t is not None and len(t) < 9000]
    words = sorted({w for t in texts for w in re.sub("[0-9]+", "0", t.lower()).split() if len(w) < 3} | {"z" * 64, "z" * 62 + "0"})[::2] + [""]
    bits = np.zeros(pii_bootstrap.SLOT_BITS // 8, np.uint8)
    for w in words:
        at = pii_bootstrap._key(w) % pii_bootstrap.SLOT_BITS
        bits[at >> 3] |= 1 << (at & 7)
    before, n = pii_bootstrap.Words(bits), 0
    for t in texts:
        got = pii_bootstrap.slots(t, before)
        assert got == plain_slots(t, set(words))
        n += len(got)
    assert n > 500


def test_graph_scores_match_plain_rounds(spark):
    r = random.Random(12)
    kinds = {i: r.choice([-1, -1, 0, 4]) for i in range(40)}
    edges = {(i, p): kinds[i] for i, p in ((r.randrange(40), r.randrange(9)) for _ in range(150))}
    rows = spark.createDataFrame([(i, p, k) for (i, p), k in edges.items()], "instance long, pattern long, kind int")
    scores, passed = pii_bootstrap.score_graph(rows)
    members = {p: {i for i, q in edges if q == p} for _, p in edges}
    seeds = {(i, k): 1.0 for (i, _), k in edges.items() if k >= 0}
    seeded, now = {i for i, _ in seeds}, dict(seeds)
    for _ in range(pii_bootstrap.ROUNDS):
        sure = {}
        for p, held in members.items():
            for kind in (0, 4):
                total = sum(now.get((i, kind), 0) for i in held)
                if len(held) >= 5 and total / (len(held) + 1) >= 0.3:
                    sure[p, kind] = total / (len(held) + 1)
        told = {}
        for (p, kind), c in sure.items():
            for i in members[p]:
                told[i, kind] = 1 - (1 - told.get((i, kind), 0)) * (1 - c)
        now = {**{x: v for x, v in told.items() if x[0] not in seeded}, **seeds}
    assert {(x.instance, x.kind): round(x.score, 9) for x in scores.collect()} == {x: round(v, 9) for x, v in told.items()}
    assert {(x.pattern, x.kind): round(x.confidence, 9) for x in passed.collect()} == {x: round(v, 9) for x, v in sure.items()}


# --- toxicity ---

def toxic_docs(n, seed, words=("blargh", "vexitol")):
    r, rows = random.Random(seed), []
    for k in range(n):
        text = prose(seed * 10_000 + k, r.randrange(20, 200)).split()
        bad = k % 4 == 0
        if bad:
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((" ".join(text), int(bad)))
    return rows


def test_model_finds_unseen_misspellings():
    train = toxic_docs(600, 1)
    model = toxicity.train([t for t, _ in train], [y for _, y in train])
    for word in ("blargh", "blaargh", "vexitolz", "vexxitol"):
        held = toxic_docs(200, 2, (word,))
        score = model.scores([t for t, _ in held])
        bad = np.array([y for _, y in held]) == 1
        assert np.mean(score[bad][:, None] > score[~bad][None, :]) > 0.9, word
    long = prose(8, 20_000)
    assert model.score(long + " blargh vexitol blargh") > 10 * model.score(long)


def test_scores_ignore_held_out_labels(spark):
    rows = [(k, *row) for k, row in enumerate(toxic_docs(160, 3))]
    docs = frame(spark, [t for _, t, _ in rows] + [None, "", "!!"], [k for k, _, _ in rows] + [1000, 1001, 1002])
    held = {k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    table = lambda flip: spark.createDataFrame(
        [(k, 1, 1 - y if flip and k in held else y) for k, _, y in rows], "doc_id long, quality int, toxic int")
    quick = toxicity.Settings(epochs=5)
    a, b = ({r.doc_id: r for r in toxicity.score_report(docs, table(flip), quick).collect()} for flip in (False, True))
    assert {k for k, r in a.items() if r.held_out} == {k for k in a if zlib.crc32(str(k).encode()) % 4 == 2}
    assert all(a[k].score == b[k].score and 0 <= a[k].score <= 1 for k in a)
    assert all(r.predicted == (r.score >= 0.3) for r in a.values()) and len(a) == 163
    none = toxicity.score_report(docs, table(False).limit(0), quick)
    assert {round(r.score, 6) for r in none.collect()} == {0.0}
    assert toxicity.score_report(docs.limit(0), table(False).limit(0), quick).count() == 0


def plain_score(text, model):
    """One document's score by the definition: means of bucket values, runs of one word once, the worst window."""
    s, mask = model.settings, 2**64 - 1

    def mixed(h):
        h = ((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & mask
        return (h ^ (h >> 29)) % s.buckets

    def value(word):
        code = [ord(c) for c in f"<{word}>"]
        base, power, total = 0x9E3779B97F4A7C15, 1, 0
        for c in code:
            power = power * base & mask
            total = (total + c * power) & mask
        buckets = [mixed(total)]
        for n in range(3, 6):
            for at in range(len(code) - n + 1):
                h = n
                for c in code[at:at + n]:
                    h = (h * base + c) & mask
                buckets.append(mixed(h))
        return sum(float(model.bucket_logits[b]) for b in buckets) / len(buckets)

    words, run = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            run += c
        elif run:
            words += [run] * (run not in words[-1:])
            run = ""
    best = 0.0
    if words:
        n = len(words)
        starts = [0] if n <= 16 else [*range(0, n - 16, 8), n - 16]
        best = max(sum(map(value, words[k:k + 16])) / min(16, n) for k in starts)
    return 1 / (1 + math.exp(-(best + model.bias)))


def test_scores_match_a_plain_scorer(spark):
    train = toxic_docs(200, 5)
    model = toxicity.train([t for t, _ in train], [y for _, y in train], toxicity.Settings(epochs=8))
    texts = [t for t, _ in toxic_docs(12, 6)] + ["", "a", "no no no no yes", "Éa ß ǅ w_x 3.14", prose(7, 400), "x" * 500]
    docs = frame(spark, texts * 2, list(range(2 * len(texts))))
    got = {r.doc_id: r.score for r in docs.select("doc_id", toxicity.toxicity("text", model, spark).alias("score")).collect()}
    for k, text in enumerate(texts):
        assert abs(got[k] - plain_score(text, model)) < 1e-6 and got[k] == got[k + len(texts)], text
