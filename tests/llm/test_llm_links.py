"""Vector links by pivots, conversation repair and phrase collocations: against brute force."""

import hashlib
import itertools
import os
import random
import re
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from cases import awkward_texts, frame  # noqa: E402

from airlens.llm import collocations, graph, pivot_links, turn_repair  # noqa: E402

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def test_components_of_chains_and_stars(spark):
    r = random.Random(5)
    pairs = [(k, k + 1) for k in range(100, 130)] + [(999, k) for k in range(200, 230)] + [(7, 7), (3, 2), (2, 3)]
    pairs += [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(120)]
    low = {x: x for p in pairs if p[0] != p[1] for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    got = graph.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {tuple(x) for x in got.collect()} == set(low.items())
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- vectors ---

VECTORS = "vec_id long, embedding array<float>, label int, node string, block int, pivot string"


def plain_links(rows):
    """{vec_id: (links, component)} by all pairs; rows have distinct ids."""
    good = {}
    for i, v, label, *_ in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.asarray(v, np.float32).astype(np.float64))
    links, low = defaultdict(set), {r[0]: r[0] for r in rows}
    for a, b in itertools.combinations(sorted(good), 2):
        (la, x), (lb, y) = good[a], good[b]
        if la == lb and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
            links[a].add(b)
            links[b].add(a)
    for _ in rows:
        for a in links:
            low[a] = min(low[a], *(low[b] for b in links[a]))
    return {r[0]: (len(links[r[0]]), low[r[0]]) for r in rows}


def vectors(seed=3, groups=12, size=14, dim=32):
    r = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        center = r.standard_normal(dim)
        for _ in range(size):
            v = center + r.standard_normal(dim) * 0.08
            rows.append((len(rows), [float(np.float32(x)) for x in v], g % 3, "x", 1, None))
    return rows


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_vector_links_match_brute_force(spark, block_rows):
    rows = vectors()
    rows += [(500 + k, rows[3][1], rows[3][2], "x", 1, None) for k in range(40)]                # exact copies
    rows += [(560, rows[3][1], None, "x", 1, None), (561, None, 1, None, 1, None), (562, [], 1, "x", 1, None),
             (563, [0.0] * 32, 1, "x", 1, None), (564, [float("nan")] * 32, 1, "x", 1, None),
             (565, [None] * 32, 1, "x", 1, None), (566, [3e38] * 32, 1, "x", 1, None), (567, [1e-38] * 32, 1, "x", 1, None),
             (568, [1.0] * 5, 1, "x", 1, None), (569, [2.0] * 5, 1, "x", 1, None), (570, [1.0] * 40, 1, "x", 1, None),
             (571, [float("inf")] * 32, 1, "x", 1, None)]
    expected = plain_links(rows)
    got = {r["vec_id"]: r for r in pivot_links.linked_vectors(
        spark.createDataFrame(rows, VECTORS), block_rows=block_rows).collect()}
    assert set(got) == set(expected)
    assert sum(n for n, _ in expected.values()) > 1000
    found = sum(got[i]["n_links"] for i in got) / sum(n for n, _ in expected.values())
    assert 0.99 <= found <= 1
    assert all(got[i]["n_links"] <= n for i, (n, _) in expected.items())
    assert {i: got[i]["component_id"] for i in got} == {i: c for i, (_, c) in expected.items()}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert got[566]["n_links"] == 1 and got[568]["component_id"] == 568 == got[569]["component_id"]


def test_vector_links_of_a_large_group_are_all_counted(spark):
    r = np.random.default_rng(1)
    center = r.standard_normal(24)
    rows = [(k, [float(np.float32(x)) for x in center + r.standard_normal(24) * 0.01], 4, "x", 1, None) for k in range(300)]
    got = pivot_links.linked_vectors(spark.createDataFrame(rows, VECTORS), block_rows=32).collect()
    assert {x["n_links"] for x in got} == {299} and {x["component_id"] for x in got} == {0}


def test_vector_links_null_and_repeated_ids_and_empty_tables(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(None, v, 1, "x", 1, None), (None, v, 1, "x", 1, None), (5, v, 1, "x", 1, None), (5, v, 1, "x", 1, None),
            (5, None, 1, "x", 1, None), (6, [2.0, 4.0, 6.0], 1, "x", 1, None)]
    got = sorted(map(tuple, pivot_links.linked_vectors(spark.createDataFrame(rows, VECTORS)).collect()), key=repr)
    assert got == sorted([(None, 0, None, True), (None, 0, None, True), (5, 1, 5, True), (6, 1, 5, False)], key=repr)
    assert pivot_links.linked_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_vector_links_recall_on_given_vectors(spark):
    """Noisy copies of the table's own vectors, at cosines around the threshold."""
    r = np.random.default_rng(2)
    table = [t for t in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [(t["vec_id"], t["embedding"], t["label"], "x", 1, None) for t in table]
    for t in table:
        v = np.asarray(t["embedding"], np.float64)
        noise = r.standard_normal(len(v))
        noise *= np.linalg.norm(v) / np.linalg.norm(noise) * r.uniform(0.05, 0.22)
        rows.append((10_000 + t["vec_id"], [float(np.float32(x)) for x in v + noise], t["label"], "x", 1, None))
    expected = plain_links(rows)
    got = {x["vec_id"]: x["n_links"] for x in pivot_links.linked_vectors(spark.createDataFrame(rows, VECTORS)).collect()}
    assert all(got[i] <= n for i, (n, _) in expected.items())
    assert sum(got.values()) >= 0.98 * sum(n for n, _ in expected.values()) > 500


# --- conversation repair ---

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain_cheapest(turns):
    """Least (cost, audit) over every choice of edits, with up to two inserts in each place."""
    best = None
    for edits in itertools.product("DKR", repeat=len(turns)):
        for inserts in itertools.product(range(3), repeat=len(turns) + 1):
            cost, audit, roles = 3 * sum(inserts), "", ""
            for k, many in enumerate(inserts):
                for _ in range(many):
                    roles, audit = roles + NEXT[roles[-1:]], audit + "I"
                if k == len(turns):
                    break
                edit, turn = edits[k], turns[k]
                if edit != "D" and turn == "-" or edit == "K" and turn in "xX":
                    roles = "?"
                    break
                audit += edit
                cost += {"D": 4, "K": 0, "R": 3}[edit] + (3 if turn.isupper() and edit != "D" else 0)
                roles += {"D": "", "K": turn.lower(), "R": NEXT[roles[-1:]]}[edit]
                if not re.match(r"s?(ua)*u?\Z", roles):
                    roles = "?"
                    break
            if re.match(r"(s?(ua)+)?\Z", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_cheapest_edits_match_every_choice():
    for n in range(4):
        for turns in itertools.product("suaxSUA-", repeat=n):
            turns = "".join(turns)
            assert turn_repair.cheapest(turns) == plain_cheapest(turns), turns
    r = random.Random(1)
    for _ in range(40):
        turns = "".join(r.choice("suauauauSUAx-") for _ in range(4))
        assert turn_repair.cheapest(turns) == plain_cheapest(turns), turns


def plain_search(turns):
    """The same by a search over (cost, audit) pairs, without numbers: for longer conversations."""
    after = {"": (0, ""), "a": (0, "")}

    def insert(after):
        for _ in range(2):
            ways = {s: [w for w in [after.get(s)] if w] + [(w[0] + 3, "I" + w[1]) for w in [after.get(NEXT[s])] if w] for s in NEXT}
            after = {s: min(w) for s, w in ways.items() if w}
        return after

    after = insert(after)
    for turn in reversed(turns):
        now, extra = {}, 3 * turn.isupper()
        for s in ("", "s", "u", "a"):
            ways = []
            if s in after:
                ways.append((after[s][0] + 4, "D" + after[s][1]))
            if turn != "-" and NEXT[s] in after:
                ways.append((after[NEXT[s]][0] + 3 + extra, "R" + after[NEXT[s]][1]))
            if (s + turn.lower()) in ("s", "u", "su", "ua", "au") and turn.lower() in after:
                ways.append((after[turn.lower()][0] + extra, "K" + after[turn.lower()][1]))
            if ways:
                now[s] = min(ways)
        after = insert(now)
    return after[""]


def test_cheapest_edits_of_long_conversations():
    r = random.Random(2)
    for n in (9, 40, 300):
        for _ in range(6):
            turns = "".join(r.choice("suuauaxSUA--") for _ in range(n))
            assert turn_repair.cheapest(turns) == plain_search(turns)
    assert turn_repair.cheapest("-" * 50) == (200, "D" * 50)


def plain_repair(rows):
    """{conv_id: the contract's row}, in plain Python."""
    out, kept = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        out.setdefault(conv, None)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        damage = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if damage == 1:
            text = ""
        if damage == 2:
            text = "".join(c for c in text if c not in ".!?")
        if damage == 4:
            role = "user"
        kept[conv] += [(turn, role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1)
    for conv in out:
        turns = sorted(kept[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, codes, faults = set(), "", Counter()
        for _, role, text in turns:
            end = text.rstrip(SPACES)
            fault = ("blank" if not end else "duplicate" if (role, text) in seen else
                     "truncated" if end[-1] not in ".!?" else "none")
            seen.add((role, text))
            faults[fault] += 1
            code = role[0] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("blank", "duplicate") else code.upper() if fault == "truncated" else code
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = plain_search(codes)
        lines, state, rest = [], "", iter(turns)
        for letter in audit:
            turn = None if letter == "I" else next(rest)
            if letter == "D":
                continue
            state = turn[1][0] if letter == "K" else NEXT[state]
            role = turn[1] if letter == "K" else {"u": "user", "a": "assistant"}[state]
            lines.append(f"{role}:{'' if turn is None else turn[2]}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)
    return out


TURNS = "conv_id long, turn long, role string, text string, place int, code string, copy string"


def repaired(spark, rows):
    df = turn_repair.repair_report(spark.createDataFrame([(*r, 1, "x", None) for r in rows], TURNS))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def test_repair_matches_plain_python(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert repaired(spark, table) == plain_repair(table)


def test_repair_of_awkward_conversations(spark):
    r = random.Random(4)
    texts = ["Yes.", "no", "", " \t\x0b", "What? ", "é漢 😀!\n", None, ":a\nuser:b.", "x" * 20000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher", "Ünder"]
    rows = [(c, r.choice([None, *range(9), 40]), r.choice(roles), r.choice(texts)) for c in [None, *range(60)] for _ in range(7)]
    rows += [(900 + k, k, "user", "Only one.") for k in range(80)]        # some lose their only turn
    rows += [(2000, k % 50, ("user", "assistant")[k % 2], f"Line {k % 90}.") for k in range(400)] + [(2001, 1, "user", "Hi.")] * 30
    got, expected = repaired(spark, rows), plain_repair(rows)
    assert got == expected
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert empty in [got[900 + k] for k in range(80)]
    assert turn_repair.repair_report(spark.createDataFrame([], TURNS)).count() == 0


# --- collocations ---

def plain_collocations(rows, support, best):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    held = [p for p in f if len(p) > 2 and f[p] >= support]
    out = []
    for p in held:
        if any(len(q) > len(p) and q[0] == p[0] and f[q] >= f[p] and
               any(q[i:i + len(p) - 1] == p[1:] for i in range(1, len(q) - len(p) + 2)) for q in held):
            continue
        cuts = []
        for k in range(2, len(p)):
            l, r = f[p[:k]], f[(p[0], *p[k:])]
            cuts.append((Fraction(1000 * f[p] * n[p[0]], l * r).__floor__(), k, l, r))
        score, _, l, r = min(cuts)
        out.append((p[0], " ".join(p[1:]), f[p], l, r, n[p[0]], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, k, *x[1:]) for k, x in enumerate(own[:best], 1)]
    return sorted(ranked)


def phrase_rows():
    r = random.Random(8)
    words = ["Ab", "bc", "ç", "漢", "dd", "e-e", "f", "\x00", "*"]
    rows = [(r.choice(["en", "en", "fr", None]), " ".join(r.choice(words[:r.randrange(2, 10)]) + r.choice(["", "", "", ".", "\n", "\t"])
                                                         for _ in range(r.randrange(90)))) for _ in range(120)]
    rows += [("en", "a b c d e f " * 30), ("en", "z z z z z z z z z z z z z"), ("und", "Ab bc. " * 12), (None, None), ("en", ""), ("xx", ".,;")]
    return rows + [(None if k % 7 == 0 else "en", t) for k, t in enumerate(awkward_texts()[:12]) if t is None or len(t) < 9000]


@pytest.mark.parametrize("support,shard_words,chunk_words", [(10, 1 << 22, 1 << 18), (10, 300, 40), (3, 60, 10)])
def test_collocations_match_brute_force(spark, support, shard_words, chunk_words):
    rows = phrase_rows()
    docs = frame(spark, [t for _, t in rows]).drop("lang")
    langs = spark.createDataFrame([(k, l) for k, (l, _) in enumerate(rows) if k != 3], "doc_id long, lang string")
    docs = docs.join(langs, "doc_id", "left")
    rows[3] = (None, rows[3][1])      # the row without an id has no language
    got = collocations.collocations(docs, support=support, best=40, shard_words=shard_words, chunk_words=chunk_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, support, 40)


def test_collocation_scores_beyond_64_bits(spark):
    a = 3 * 10**9
    counts = spark.createDataFrame([("en", "x", 1, a), ("en", "y", 1, a + 1), ("en", "x y", 2, a)],
                                   "lang string, phrase string, length int, f long")
    totals = spark.createDataFrame([("en", 7 * 10**15)], "lang string, n long")
    row = collocations.scored(counts, totals).first()
    assert row["score"] == 1000 * a * 7 * 10**15 // (a * (a + 1))


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(frame(spark, []).limit(0)).count() == 0


def test_shards_of_a_batch_are_worked_on_one_by_one():
    """A batch's shards become Python objects one at a time, and work on a shard takes few times its size."""
    r, n, rows = random.Random(3), 1 << 18, []
    names = [b"w%d" % k for k in range(300)]
    for _ in range(4):
        chunk = collocations._chunk("en", [[names[min(r.randrange(300), r.randrange(300))] for _ in range(n)]])
        rows.append({"lang": "en", "least": 4, "words": [chunk[1]] * 4, "codes": [chunk[2]] * 4})
    schema = pa.schema([("lang", pa.string()), ("least", pa.int32()), ("words", pa.list_(pa.list_(pa.binary()))),
                        ("codes", pa.list_(pa.binary()))])
    batch = pa.RecordBatch.from_pylist(rows, schema)
    every = [collocations.Bits(np.full(1 << 12, 255, np.uint8))] * 5
    tracemalloc.start()
    seen = 0
    for lang, least, shard in collocations._each(iter([batch])):
        seen += len(shard.places(1))
        for length in range(1, 6):
            assert sum(len(f) for _, f, _ in collocations.mine(shard, range(length, length + 1), least, every[0])) > 100
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 16 * n and peak < 56 * 4 * n
    told = [(length, [p.as_py() for p in phrases], np.frombuffer(counts, np.int64).tolist())
            for length, _, phrases, counts in collocations.counted(shard, [collocations.Bits(np.full(1 << 12, 255, np.uint8))] * 2, 2, 4)]
    words = [names[int(w[1:])] for w in [shard.words[int(k)].as_py() for k in shard.word[shard.left > 0][:n]]]
    for length, plain in ((1, Counter(words)), (2, Counter(b" ".join(p) for p in zip(words, words[1:])))):
        assert {p: c for size, ps, cs in told if size == length for p, c in zip(ps, cs)} == {p: 4 * c for p, c in plain.items()}


def test_a_long_text_is_cut_between_pieces_only():
    words = collocations.words_and_breaks(b"a b c. d e f g h i! j k " * 50)
    parts = list(collocations._portions(words, 7))
    assert sum(parts, []) == words and len(parts) > 20
    assert all(p[0] == b"." for p in parts[1:])
