"""Near-duplicates, line templates, top-k search, URL filters, chat formatting, mixing: against brute force."""

import hashlib
import os
import random
import sys
from collections import Counter, defaultdict
from itertools import combinations, permutations

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from cases import awkward_texts, frame, prose  # noqa: E402

from airlens.llm import chat_format, line_templates, minmax_dedup, mixing, topk_blocks, url_cascade  # noqa: E402

SPACES = " \t\n\x0b\x0c\r"


def lowered_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in SPACES[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


# --- near-duplicates ---

def plain_groups(rows):
    """{id: (set size, smallest reachable id)}; pairs all against all."""
    sets = []
    for _, text in rows:
        w = lowered_words(text or "")
        sets.append({tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if rows[a][0] == rows[b][0] or both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            group[top(a)] = top(b)
    low = defaultdict(list)
    for k in range(len(rows)):
        low[top(k)].append(rows[k][0])
    return [(rows[k][0], len(sets[k]), min(low[top(k)]) if sets[k] else rows[k][0]) for k in range(len(rows))]


def near_copies():
    r, texts = random.Random(11), [t for t in awkward_texts()]
    base = prose(70, 120).split()
    for _ in range(25):  # a group that hangs together by chains, not through one document
        base = list(base)
        base[r.randrange(len(base))] = f"edit{r.randrange(10**6)}"
        texts.append(" ".join(base))
    for k in range(12):  # short texts on both sides of the limit
        words = prose(71, 24).split()
        if k:
            words[r.randrange(24)] = f"x{k}"
        texts.append(" ".join(words))
    return texts


def test_near_duplicates_match_brute_force(spark):
    texts = near_copies()
    ids = list(range(100, 100 + len(texts)))
    random.Random(2).shuffle(ids)
    ids[3] = 5  # and a repeated row
    texts.append(texts[-1])
    ids.append(ids[-1])
    got = sorted(tuple(r)[:3] for r in minmax_dedup.near_duplicates(frame(spark, texts, ids)).collect())
    assert got == sorted(plain_groups(list(zip(ids, texts))))


def test_links_of_a_cell_join_what_all_pairs_join():
    """A cell tells fewer links than it has components, and they reach as far as all pairs do."""
    r = np.random.default_rng(3)
    for trial in range(40):
        n, base, sets = 40, [np.unique(r.integers(0, 10**9, 60)) for _ in range(4)], []
        for _ in range(n):
            copy, edits = base[r.integers(4)].copy(), r.integers(0, 14)
            copy[r.choice(len(copy), edits, replace=False)] = r.integers(0, 10**9, edits)
            sets.append(np.unique(copy))
        component = r.integers(0, 25, n)
        block = r.integers(0, 2, n) if trial % 2 else np.zeros(n, np.int64)
        pairs = []
        for a, b in combinations(range(n), 2):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and component[a] != component[b] \
                    and (block[a] != block[b] or not block.any()):
                pairs.append((a, b))

        def reached(links):
            low = {c: c for c in component}
            for _ in range(n):
                for a, b in links:
                    low[component[a]] = low[component[b]] = min(low[component[a]], low[component[b]])
            return low

        got = minmax_dedup.links_in_cell(np.arange(n), component, block, sets)
        assert set(got) <= set(pairs) and reached(got) == reached(pairs) and len(got) < len(set(component))


def test_sets_go_out_in_small_frames():
    """A batch's sets are not held together: each frame covers a few texts, all of them in order."""
    texts = [prose(k, 400) for k in range(60)] * 50
    words = minmax_dedup.Words()
    told = [minmax_dedup.shingles(t, words).view(np.int64) for t in texts[:60]] * 50
    frames = list(minmax_dedup._features.func(iter([pd.Series(texts)])))
    assert len(frames) >= sum(map(len, texts)) >> 21 > 1
    assert [n for f in frames for n in f["n"]] == [len(s) for s in told]
    parts = list(minmax_dedup._sets.func(iter([pd.Series(texts)])))
    assert len(parts) == len(frames)
    assert all(np.array_equal(a, b) for a, b in zip([s for p in parts for s in p], told, strict=True))


def test_near_duplicates_without_id_or_rows(spark):
    docs = frame(spark, awkward_texts())
    out = {r.doc_id: r for r in minmax_dedup.near_duplicates(docs).collect()}
    assert out[None].kept and out[None].component_id is None and out[7].component_id == 6 and not out[7].kept
    kept = minmax_dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in out.values())
    assert minmax_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_signature_estimates_similarity_without_bias():
    r = np.random.default_rng(0)
    shared, total = 0, 0
    for _ in range(60):
        x = r.integers(0, 2**63, 300).astype(np.uint64)
        a, b = np.unique(x[:200]), np.unique(x[100:])
        shared += (minmax_dedup.signature(a) == minmax_dedup.signature(b)).sum()
        total += 2 * minmax_dedup.PERMUTATIONS
    assert abs(shared / total - 1 / 3) < 0.03


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 102), (101, 102)], "a long, b long")
    got = {r.node: r.component for r in minmax_dedup.components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


# --- line templates ---

def window_numbers(text, number):
    """Hashes of the 24-byte windows that start in a line (its line end counts; none at the end of the text)."""
    raw, lines = text.encode() + bytes(40), text.split("\n")
    start = sum(len(x.encode()) + 1 for x in lines[:number])
    odd, mask, out = 0x9E3779B97F4A7C15, 2**64 - 1, []
    for at in range(start, min(start + len(lines[number].encode()) + 1, len(text.encode()))):
        h = odd
        for k in (0, 8, 16):
            h = ((h ^ int.from_bytes(raw[at + k:at + k + 8], "little")) * odd) & mask
            h ^= h >> 29
        out.append((h * odd) & mask)
    return out


def plain_sketch(windows):
    """128 buckets by the first bits; of each the smallest window tells a byte, 0 where there is none."""
    least = {}
    for h in windows:
        least[h >> 57] = min(least.get(h >> 57, h), h)
    return bytes((least[b] & 0xFFFF) % 255 + 1 if b in least else 0 for b in range(128))


def plain_resemblance(a, b):
    return sum(x == y != 0 for x, y in zip(a, b)) / max(1, sum(x + y > 0 for x, y in zip(a, b)))


def far_apart(sketches):
    """Three texts, each the least like those before, from the smallest sketch or the one least like it: no two copies?"""
    least = lambda taken: min((max(plain_resemblance(s, t) for t in taken), s) for s in sketches)
    start = min(sketches)
    for taken in ([start], [least([start])[1]]):
        while len(taken) < 3:
            near, found = least(taken)
            if near >= 0.6:
                break
            taken.append(found)
        if len(taken) == 3:
            return True
    return False


def plain_boilerplate(texts):
    """Line numbers to drop for each text: every line against every other of its leaf, every text against every other."""
    parsed, windows = {}, {}
    for t in sorted({t or "" for t in texts}):
        rows = []
        for no, line in enumerate(t.split("\n")):
            tokens = ["<*>" if any("0" <= c <= "9" for c in w) else w for w in line.split()]
            if tokens:
                rows.append((no, " ".join(tokens)))
        parsed[t] = rows
    leaves, count, leaf_texts = defaultdict(set), Counter(), defaultdict(set)
    leaf_of = lambda line: (line.count(" "), tuple(line.split(" ")[:3]))
    for t, rows in parsed.items():
        for line in {line for _, line in rows}:
            count[line] += 1
            leaves[leaf_of(line)].add(line)
            leaf_texts[leaf_of(line)].add(t)
    template = {}
    for leaf, lines in leaves.items():
        if len(leaf_texts[leaf]) < 3:
            continue
        todo = sorted(lines, key=lambda x: (-count[x], x))
        while todo:
            first = todo[0].split(" ")
            near = [x for x in todo if x == todo[0]
                    or sum(a == b for a, b in zip(first, x.split(" "))) / len(first) >= 0.8]
            fixed = [t[0] if len(set(t)) == 1 else "<*>" for t in zip(*(x.split(" ") for x in near))]
            for x in near:
                template[x] = (leaf, " ".join(fixed))
            todo = [x for x in todo if x not in near]
    votes, where = defaultdict(dict), defaultdict(list)
    for t, rows in parsed.items():
        for no, line in rows:
            told = template.get(line, (None, "<*>"))[1].split(" ")
            others = {n for n, other in rows if other != line}
            if not others or "<*>" in told and sum(w != "<*>" for w in told) < 3:
                continue
            for n in others:
                if (t, n) not in windows:
                    windows[t, n] = window_numbers(t, n)
            if t not in votes[template[line]]:      # the first such line of a text speaks for it
                votes[template[line]][t] = plain_sketch([h for n in others for h in windows[t, n]])
            where[template[line]].append((t, no))
    gone = {x for key, sketch in votes.items() if far_apart(list(sketch.values())) for x in where[key]}
    return [[no for no, _ in parsed[t or ""] if (t or "", no) in gone] for t in texts]


def pages():
    r, texts = random.Random(21), list(awkward_texts())
    passage = prose(400, 70)
    for k in range(24):
        lines = [prose(500 + k, 30), prose(600 + k, 12)]
        if k % 2:
            lines.insert(0, f"Posted by user{k} on 2024-01-{k + 1:02d} at site")
        if k % 3 == 0:
            lines.insert(r.randrange(len(lines)), f"All rights are reserved by {r.choice(['Ann', 'Bob', 'Cy'])} here now ok yes")
        if k % 4 == 0:
            lines.append(passage)
        texts.append("\n".join(lines))
    texts += [texts[-1]] * 5 + ["12 34 56\n" + prose(700 + k, 9) for k in range(4)] + ["only one line here"] * 4
    return texts


def test_line_templates_match_brute_force(spark):
    texts = pages()
    docs = frame(spark, texts, list(range(len(texts))))
    got = {r.doc_id: r for r in line_templates.line_report(docs).collect()}
    expected = plain_boilerplate(texts)
    assert sum(map(len, expected)) > 20
    for k, (text, gone) in enumerate(zip(texts, expected)):
        assert got[k].dropped == ",".join(map(str, gone)), (k, text)
        kept = "\n".join(x for no, x in enumerate((text or "").split("\n")) if no not in gone)
        assert got[k].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    out = line_templates.drop_boilerplate(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("doc_id = 0").first().text is None
    assert line_templates.drop_boilerplate(docs.limit(0)).count() == 0


def test_edited_copies_keep_their_lines(spark):
    """A group of near copies shares most lines, but no line of it is boilerplate; a footer of other documents is."""
    r, base = random.Random(31), [prose(800 + k, 40) for k in range(8)]
    texts = []
    for _ in range(30):
        words = [line.split() for line in base]
        for _ in range(4):
            line = r.choice(words)
            line[r.randrange(len(line))] = f"edit{chr(97 + r.randrange(26))}{chr(97 + r.randrange(26))}"
        texts.append("\n".join(" ".join(w) for w in words))
    texts += [prose(900 + k, 50) + "\nAll the rights are reserved here\nPage 1 of 9 in this book" for k in range(8)]
    got = {x.doc_id: x.n_dropped for x in line_templates.line_report(frame(spark, texts, list(range(38)))).collect()}
    assert [got[k] for k in range(38)] == [0] * 30 + [2] * 8


def test_templates_are_the_same_at_any_leaf_size(spark, monkeypatch):
    """Also where the variable word is early, and where templates chain."""
    r = random.Random(41)
    lines = {f"Posted by user {w} in the forum" for w in prose(42, 60).split()}
    lines |= {" ".join(["a", "b", "c"] + [r.choice("xyz") for _ in range(r.choice((4, 7)))]) for _ in range(150)}
    lines |= {f"a b c {w}" for w in "pqrstuvw"}
    lines = [(f"{len(x.split())}{x[:5]}", x) for x in sorted(lines)]
    leaf = {name: k for k, name in enumerate(sorted({name for name, _ in lines}))}
    rows = spark.createDataFrame([(leaf[name], k, x, 1 + k % 3) for k, (name, x) in enumerate(lines)],
                                 "leaf long, line long, masked string, n_texts long")
    told = []
    for size in (2048, 50, 7):
        monkeypatch.setattr(line_templates, "LEAF_LINES", size)
        told.append(sorted(tuple(x) for x in line_templates.templates_of(rows).collect()))
    assert told[0] == told[1] == told[2] and len(told[0]) == len(lines)
    posted = {t for k, t, *_ in told[2] if lines[k][1].startswith("Posted")}
    assert len(posted) == 1 and len({t for _, t, *_ in told[0]}) > 12


def test_three_unlike_texts_are_found_in_any_order(spark):
    """A is like B, C and D, which are unlike each other: found whatever text comes first, and not without D."""
    r = np.random.default_rng(7)
    a = r.integers(1, 200, 128).astype(np.uint8)
    other = [(0, 51), (43, 94), (77, 128)]
    near = [np.where((np.arange(128) >= x) & (np.arange(128) < y), 201 + k, a).astype(np.uint8).tobytes()
            for k, (x, y) in enumerate(other)]
    assert all(plain_resemblance(a.tobytes(), x) >= 0.6 for x in near)
    assert all(plain_resemblance(x, y) < 0.6 for x, y in combinations(near, 2))
    rows = [(8 * k + j, bytearray(order[j])) for k, order in enumerate(permutations([a.tobytes(), *near])) for j in range(4)]
    rows = [(n // 8, s) for n, s in rows] + [(99, bytearray(s)) for s in (a.tobytes(), *near[:2])]
    got = line_templates.spread_templates(spark.createDataFrame(rows, "template long, sketch binary"))
    assert sorted(x.template for x in got.collect()) == list(range(24))


def test_blocks_of_lines_go_from_unrelated_documents(spark):
    """Header and footer lines of half and of two thirds of the text, whichever window hash is smallest."""
    texts, expected = [], []
    for block in range(12):
        header = [f"{prose(1000 + 10 * block + k, 12 if block % 2 else 24)} block" for k in range(4)]
        for k in range(6):
            own = prose(2000 + 10 * block + k, 48)
            texts.append("\n".join(header[:2] + [own] + header[2:]))
            expected.append("0,1,3,4")
    got = {x.doc_id: x.dropped for x in line_templates.line_report(frame(spark, texts, list(range(len(texts))))).collect()}
    assert [got[k] for k in range(len(texts))] == expected


def test_a_large_copy_group_does_not_hide_a_footer(spark):
    """A footer of unrelated documents goes from all of them and from 150 edited copies of one, whose lines stay."""
    r, footer = random.Random(51), "Read the terms of use before you go on"
    base = [prose(3000 + k, 40) for k in range(8)]
    texts = [prose(3100 + k, 60) + "\n" + prose(3200 + k, 60) + "\n" + footer for k in range(20)]
    for _ in range(150):
        words = [line.split() for line in base]
        for _ in range(3):
            line = r.choice(words)
            line[r.randrange(len(line))] = f"edit{chr(97 + r.randrange(26))}{chr(97 + r.randrange(26))}"
        texts.append("\n".join([*(" ".join(w) for w in words), footer]))
    got = {x.doc_id: x.dropped for x in line_templates.line_report(frame(spark, texts, list(range(170)))).collect()}
    assert [got[k] for k in range(170)] == ["2"] * 20 + ["8"] * 150


def test_short_lines_without_variables_go(spark):
    """One and two words that recur go; short lines with a variable word, and words in two texts only, stay."""
    texts = [f"{prose(4000 + k, 30)}\nLes.\nAnd ornd.\nPage {k}" + ("\nTwice" if k < 2 else "") for k in range(6)]
    got = {x.doc_id: x.dropped for x in line_templates.line_report(frame(spark, texts, list(range(6)))).collect()}
    assert [got[k] for k in range(6)] == ["1,2"] * 6


# --- top-k search ---

def plain_top(vectors, queries, k):
    out = []
    for q in queries:
        s = sorted((-int(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:k]
        out += [(q, n + 1, i, -score) for n, (score, i) in enumerate(s)]
    return out


def test_top_scores_match_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(0, 0.2, 8)]) for i in range(420)]
    rows += [(i, rows[3][1]) for i in range(420, 520)]  # ties
    rows += [(600, None), (601, []), (650, [1.0, None] + [0.0] * 6), (700, [float("nan")] + [0.0] * 7),
             (750, [float("inf")] + [0.0] * 7), (602, [1.0, 2.0]), (50, rows[50][1])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, shard int")
    vectors = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows[:520]}
    got = sorted(tuple(x) for x in topk_blocks.top_scores(table).collect())
    assert got == sorted(plain_top(vectors, [i for i in vectors if i % 50 == 0], 5))
    few = topk_blocks.top_scores(table.where("vec_id < 3")).collect()
    assert [(x.query_id, x.rank) for x in few] == [(0, 1), (0, 2)]
    assert topk_blocks.top_scores(table.limit(0)).count() == 0


def test_blocks_are_pruned_and_large_integers_exact():
    r = np.random.default_rng(1)
    centres = r.integers(-60, 60, (30, 16))
    v = np.concatenate([c + r.integers(-3, 4, (64, 16)) for c in centres]).astype(np.int64)
    ids = np.arange(len(v))
    blocks = pd.DataFrame([(ids[k:k + 64].tobytes(), m.tobytes(), m.max(0).tobytes(), m.min(0).tobytes())
                           for k in range(0, len(v), 64) for m in [v[k:k + 64]]], columns=["ids", "forward", "high", "low"])
    shard, q = topk_blocks.Shard(blocks, 16), np.arange(0, len(v), 50)
    _, found = shard.search(q, v[q], 5)
    expected = [x[2] for x in plain_top(dict(enumerate(v)), q, 5)]
    assert found.ravel().tolist() == expected and shard.scored < len(q) * len(v) / 3
    for column in ("forward", "high", "low"):
        blocks[column] = [(np.frombuffer(b, np.int64) * 10**7).tobytes() for b in blocks[column]]
    _, found = topk_blocks.Shard(blocks, 16).search(q, v[q] * 10**7, 5)
    assert found.ravel().tolist() == expected


# --- URL filters ---

def test_cascade_is_exact_in_any_number_of_shards(spark):
    rows = [(k, f"http://h{k % 7}.example.com/{k}" + ("?utm_source=x" if k % 3 == 0 else "")) for k in range(3000)]
    rows += [(9000, None), (9001, ""), (9002, "no scheme/com/"), (9003, "HTTP://WWW.Example.COM/en/?a#b"),
             (9004, "x://net/es/p"), (9005, "x://a.net/fr/#?"), (9006, "x://net"), (9007, "x://ÉXAMPLE.com\n/a b?q")]
    rows += [(k, "http://dup.org/1") for k in range(9100, 9130)] + [(9131, "http://dup.org/1?a=1&utm_medium=y")]
    table = spark.createDataFrame([(i, u, 1, True) for i, u in rows], "page_id long, url string, key int, listed boolean")
    rules = [url_cascade.Rule(*r) for r in (("allow", "com", "/"), ("block", "example.com", "/en/"),
                                            ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"))]
    for shard_keys in (10**6, 400):
        got = {r.page_id: r for r in url_cascade.judge_urls(table, rules, shard_keys=shard_keys).collect()}
        assert len(got) == len(rows)
        keys = {i: got[i].host + got[i].path for i in got}
        listed = {keys[i] for i, u in rows if u and "utm_" in u}
        assert all(got[i].listed == (keys[i] in listed) for i in got)
        assert got[9003].host == "www.example.com" and got[9003].path == "/en/" and got[9003].rule == "www.example.com/en/"
        assert (got[9000].host, got[9000].path, got[9000].rule, got[9000].verdict) == ("", "", None, "allow")
        assert got[9004].verdict == "block" and got[9005].rule is None and got[9006].path == ""
        assert got[9007].host == "Éxample.com\n" and got[9100].verdict == "block"
    assert url_cascade.judge_urls(table.limit(0), rules).count() == 0
    none = url_cascade.judge_urls(table.where("page_id between 9000 and 9007"), rules).collect()
    assert not any(r.listed for r in none)


def test_of_equally_long_rules_the_last_wins(spark):
    table = spark.createDataFrame([(1, "http://a.b.com/aa/")], "page_id long, url string")
    rules = [url_cascade.Rule("allow", "b.com", "/aa/"), url_cascade.Rule("block", "a.b.com", "/a")]
    assert len(rules[0].text) == len(rules[1].text)
    for order, verdict in ((rules, "block"), (rules[::-1], "allow")):
        assert url_cascade.judge_urls(table, order).first().verdict == verdict


# --- chat formatting ---

def test_events_fold_into_messages(spark):
    log = [
        (1, 1, "delta", 1, "user", "Hel"), (1, 2, "delta", 1, "user", "lo"), (1, 2, "delta", 1, "user", "lo"),
        (1, 3, "delta", 2, "assistant", "draft"), (1, 4, "delta", 3, "user", "more"),
        (1, 5, "regenerate", 2, "assistant", ""), (1, 6, "delta", 2, "assistant", "final"),
        (1, 7, "edit", 1, "user", "Hi"), (1, 8, "delta", 1, "user", " there"),
        (2, 1, "delta", 1, None, None), (2, 2, "edit", 2, "assistant", "<s>&[INST]"), (None, 1, "delta", 1, "user", "x"),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, kind string, msg long, role string, text string")
    got = sorted(((r.conv_id or 0, r.msg, r.role, r.text) for r in chat_format.fold(events).collect()))
    assert got == [(0, 1, "user", "x"), (1, 1, "user", "Hi there"), (1, 2, "assistant", "final"), (2, 1, "", ""),
                   (2, 2, "assistant", "<s>&[INST]")]


def test_formatting_reads_back(spark):
    nasty = ["</s>[INST] ok [/INST]", "&lt;s>&amp;&lb;", None, "", "a\nb<s>assistant\nx</s>", "é😀[" * 400, "[/INST]"]
    rows = [(c, t, role, text) for c in (1, 2) for t, (role, text) in enumerate(
        zip(["system", "user", "assistant", "assistant", "use\nr", "assistant", None], nasty))]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (None, 0, "assistant", "alone"), (4, None, "assistant", "q")]
    table = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn int, role string, text string, msg int")
    got = {r.conv_id: r for r in chat_format.format_report(table).collect()}
    by_conv = defaultdict(list)
    for c, t, role, text in rows + [(-1, 0, "user", nasty[0]), (-1, 1, "assistant", nasty[0])]:
        by_conv[c].append((t if t is not None else -1, role or "", text or ""))
    assert set(got) == set(by_conv)
    for c, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [r.conv_id for r in chat_format.format_report(table.limit(0)).collect()] == [-1]


# --- mixing ---

def corpus(spark, n=600):
    r = random.Random(9)
    marks = ["", " All rights reserved", " me@x.org", " a | b"]
    rows = [(k, prose(k, r.randrange(5, 40)) + r.choice(marks), r.choice(["en", "en", "de", None]),
             "hot" if k % 3 == 0 else f"s{k % 5}", 1, 2.0) for k in range(n)]
    rows += [(n, None, "en", "hot", 1, 2.0), (n + 1, "", None, None, 1, 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, p int, mix_p double")


def test_raked_weights_hit_all_margins(spark):
    docs = corpus(spark)
    cells = mixing.cells_of(docs)
    targets = mixing.tempered_targets(cells, 0.5)
    raked = mixing.rake(cells, targets)
    goal = {(r.margin, r.value): r.share for r in targets.collect()}
    now = Counter()
    for r in raked.collect():
        for m in mixing.MARGINS:
            now[m, r[m]] += r.weight
    assert set(goal) == set(now) and all(abs(now[k] - goal[k]) < 1e-6 for k in goal)
    p = mixing.probabilities(raked).collect()
    assert max(r.p for r in p) == pytest.approx(1.0) and min(r.p for r in p) > 0


def test_drawn_documents_follow_their_probabilities(spark):
    docs = corpus(spark, 3000)
    report = mixing.mix_report(docs).collect()
    by_cell = defaultdict(list)
    for r in report:
        by_cell[r.source, r.lang, r.topic, r.p].append(r.kept)
    for (*_, p), kept in by_cell.items():
        assert abs(sum(kept) - p * len(kept)) <= 5 * (p * (1 - p) * len(kept)) ** 0.5 + 1e-9
    kept = mixing.mix(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in report if r.kept}
    assert mixing.mix(docs.limit(0)).count() == 0
