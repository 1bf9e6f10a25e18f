"""Components, line groups and the Jaccard join against brute force."""

import random

import numpy as np
import pytest
import xxhash

from llm_fixtures import docs_of, scratch  # noqa: F401
from pricelake.llm import graph, jaccard, lines
from pricelake.llm.shingles import overlap, shingle_set, word_hashes

WORDS = [a + b for a in "abcdefgh" for b in ("ra", "to", "mi", "lu", "ne")]


def closed(nodes, linked):
    """Smallest reachable node of every node."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


@pytest.mark.parametrize("local", [0, 1000])
def test_components(spark, scratch, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL_EDGES", local)
    rng = random.Random(1)
    edges = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(70)] + [(100 + i, 101 + i) for i in range(40)] + [(500, i) for i in range(300, 340)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(scratch(), df, "c").collect()}
    expected = closed({n for e in edges for n in e}, edges)
    assert all(got.get(n, n) == m for n, m in expected.items()) and set(got) <= set(expected)
    assert graph.components(scratch(), df.limit(0), "c").collect() == []


@pytest.mark.parametrize("rounds", [0, 6])
def test_every_link_between_list_members_is_found(spark, scratch, rounds):
    rng = random.Random(2)
    lists = [(k, n) for k in range(25) for n in rng.sample(range(80), rng.randint(1, 30))]
    real = {(a, b) for a in range(80) for b in range(a + 1, 80) if (a * 7 + b * 13) % 41 == 0}
    frame = spark.createDataFrame(lists, "key long, node long")
    true = spark.createDataFrame(sorted(real), "a long, b long")
    verify = lambda pairs: pairs.join(true, ["a", "b"])
    got = {r["node"]: r["component"] for r in graph.linked(scratch(), frame, verify, "x", rounds=rounds).collect()}
    members = {}
    for k, n in lists:
        members.setdefault(k, set()).add(n)
    meeting = {(a, b) for s in members.values() for a in s for b in s if (a, b) in real}
    expected = closed(range(80), meeting)
    assert all(got.get(n, n) == m for n, m in expected.items())


def test_wide_columns_join_reduced_lists(spark, scratch):
    """Thirty lists of the same members are one list, and what ``about`` says of its members rules pairs out."""
    lists = [(k, n) for k in range(30) for n in (1, 2, 3)] + [(40, 2), (40, 4)]
    about = spark.createDataFrame([(n, n % 2) for n in range(1, 5)], "node long, odd int")
    kept, asked = scratch(), []
    stored = kept.store
    kept.store = lambda df, name: asked.append((name, stored(df, name))) or asked[-1][1]
    seen = []

    def verify(pairs):
        seen.extend(tuple(r) for r in pairs.collect())
        found = dict(asked)["x-lists"]
        assert set(found.columns) == {"key", "node", "odd"} and found.count() == 5
        return pairs

    even = lambda left, right: left("odd") == right("odd")
    groups = graph.linked(kept, spark.createDataFrame(lists, "key long, node long"), verify, "x", even, about=about)
    assert {r["node"]: r["component"] for r in groups.collect()} == {1: 1, 3: 1, 2: 2, 4: 2}
    assert set(seen) == {(1, 3), (2, 4)}


def variants(rng, count, size, edits):
    base = [rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(size)]
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(size)] = rng.choice(WORDS)
        out.append(" ".join(words))
    return out


def corpus(rng):
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 14))) for _ in range(150)]
    for size in (5, 6, 7, 8, 9, 10, 12, 16, 25, 60, 200):
        texts += variants(rng, 12, size, 1 + size // 30)
        long = variants(rng, 1, size, 0)[0].split()
        texts += [" ".join(long[: len(long) - cut]) for cut in range(0, max(2, size // 5))]
    texts += ["w1 w2 w3 w4 w5 w6", "W1  w2\tw3 w4 w5\nw6"] + ["a a a a a a a a"] * 40  # a hot group of copies
    return texts + [None, "", " \t ", "one", "One", "one two", "x " * 3000]


def jaccard_truth(texts):
    sets = [None if t is None else t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split() for t in texts]
    sets = [set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in sets]
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    return sets, closed(range(len(sets)), linked)


@pytest.mark.parametrize("boundary", [None, 0, 14])
def test_jaccard_join_is_exact_whatever_the_boundary(spark, docs_of, monkeypatch, boundary):
    if boundary is not None:
        plan = jaccard.Plan.__init__
        monkeypatch.setattr(jaccard.Plan, "__init__", lambda self, *a: (plan(self, *a), setattr(self, "boundary", boundary))[0])
    texts = corpus(random.Random(3))
    sets, least = jaccard_truth(texts)
    got = {r["doc_id"]: r for r in jaccard.join_groups(docs_of([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == [least[i] for i in range(len(texts))]
    assert len(set(least.values())) < len(texts) - 80


def test_jaccard_join_of_odd_rows(spark, docs_of):
    rows = [(None, "a b c d e f", "s"), (4, "a b c d e f", "s"), (4, "a b c d e f", "s"), (9, "A b c d e f", "s"), (9, "other words", "s"), (None, None, "s")]
    got = sorted(map(str, jaccard.join_groups(docs_of(rows)).collect()))
    assert sum("component_id=4" in r for r in got) == 4 and len(got) == 6
    kept = jaccard.keep_first(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, ""), (4, "a b c d e f"), (9, "other words")]
    assert jaccard.join_groups(docs_of([])).collect() == [] and jaccard.keep_first(docs_of([])).collect() == []


def test_plan_bounds():
    plan = jaccard.Plan()
    for s in range(1, 300):
        for t in range(1, 300):
            least = next(o for o in range(s + t + 2) if 100 * o >= 80 * (s + t - o))
            assert plan.needed(s, t) == least
            if least <= min(s, t):
                assert t in plan.partners(s)
                shared = set(plan.classes(s)) & set(plan.classes(t))
                assert shared and all(s + t - 2 * least <= plan.ranges(j)[1] for j in shared)


def test_shingles_of_words():
    assert len(shingle_set("a b c d e f")) == 2 and len(shingle_set("A B")) == 1 and len(shingle_set(None)) == 0
    assert (shingle_set("É x Y z w") == shingle_set("É X y Z W")).all() and (shingle_set("é x y z w") != shingle_set("É x y z w")).any()
    rng = random.Random(4)
    text = " ".join(rng.choice(WORDS) for _ in range(200))
    assert len(set(word_hashes(text.encode()).tolist())) == len(set(text.split()))
    a, b = np.array([1, 3, 5], np.uint64), np.array([3, 4, 5, 9], np.uint64)
    assert overlap(a, b) == overlap(b, a) == 2 and overlap(a, b[:0]) == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_distance():
    rng = random.Random(5)
    for _ in range(1500):
        a, b = ("".join(rng.choice("ab c") for _ in range(rng.randint(0, 12))) for _ in "xy")
        for most in (0, 2, 20):
            assert min(lines.distance(a, b, most), most + 1) == min(edit_distance(a, b), most + 1)


def test_block_keys_find_every_near_hash():
    rng = random.Random(6)
    for blocks in (5, 6, 7):
        for _ in range(100):
            one = rng.getrandbits(64)
            two = one
            for bit in rng.sample(range(64), lines.BITS):
                two ^= 1 << bit
            keys = lines.block_keys(np.array([one, two], np.uint64), blocks)
            assert set(keys[0]) & set(keys[1])


def test_long_lists_are_thinned_to_partners():
    """Against all pairs: one key of thousands of unlike lines lets only the lines with a near one pass."""
    rng = np.random.default_rng(9)
    most = np.iinfo(np.uint64).max
    sketches = rng.integers(0, most, (3000, 2), np.uint64)
    sketches[:, 0] = sketches[:, 0] >> np.uint64(16) << np.uint64(16) | rng.integers(20, 900, 3000).astype(np.uint64)
    sketches[:40, 0] = sketches[:40, 0] >> np.uint64(16) << np.uint64(16) | np.uint64(70_000 & 0xFFFF)
    sketches[100:150] = sketches[:50] ^ np.array([1 << 20, 1 << 63], np.uint64)
    sketches = sketches.view(np.int64)
    keys = np.sort(np.where(rng.random(3000) < 0.9, 5, rng.integers(-9, 9, 3000)))
    rows = np.column_stack([keys, np.arange(3000), sketches])
    near = lines.near_sketches(sketches[:, None], sketches[None]) & (keys[:, None] == keys[None])
    expected = near.sum(1) > 1
    assert (lines.partnered(rows) == expected).all() and 0 < expected.sum() < 200
    assert lines.partnered(rows[:0]).shape == (0,)


def test_long_keys_pass_only_lines_with_a_partner(spark):
    rng = np.random.default_rng(10)
    made = rng.integers(0, np.iinfo(np.uint64).max, (2000, 2), np.uint64)
    made[:, 0] = made[:, 0] >> np.uint64(16) << np.uint64(16) | np.uint64(300)
    made[1] = made[0] ^ np.uint64(1 << 40)
    made = made.view(np.int64)
    expected = np.flatnonzero(lines.near_sketches(made[:, None], made[None]).sum(1) > 1)
    rows = [(7, n, *map(int, pair)) for n, pair in enumerate(made)]
    left = lines._near(spark.createDataFrame(rows, lines.LISTED_TYPE)).collect()
    assert sorted(r["node"] for r in left) == list(expected) and set(expected) >= {0, 1} and len(expected) < 400


def test_sketches_count_every_run():
    """Also in lines of more runs than a byte counts to."""
    given = ["x" * 3000 + " y" * 400, "a b c d e f g h", "one two three " * 19]
    for line, row in zip(given, lines.sketches(given)):
        runs, _ = lines._runs([line], lines.SKETCH_GRAM)
        drawn = np.stack([runs, lines.mix(runs + lines.U(lines.BASE))], axis=1).view(np.uint8)
        ones = np.unpackbits(drawn, axis=1, bitorder="little").sum(0)[: lines.SKETCHED]
        assert (np.unpackbits(row.view(np.uint8), bitorder="little")[16:] == (2 * ones > len(runs))).all()
        assert int(row[0]) & 0xFFFF == len(line)


def row_hash(text):
    """Spark's xxhash64 of a text."""
    return int.from_bytes(xxhash.xxh64_digest((text or "").encode(), seed=42), "big", signed=True)


def line_truth(rows):
    """Groups of lines by brute force: (id, text, line) -> first occurrence."""
    places = sorted({(i is not None, i or 0, row_hash(t), n, x) for i, t, _ in rows for n, x in enumerate(lines.normal_lines(t or "")) if x})
    classes = sorted({p[4] for p in places})
    hashes = lines.simhashes(classes)
    sketches = lines.sketches(classes).view(np.int64)
    meet = lambda a, b: (np.bitwise_count(hashes[a] ^ hashes[b]) <= lines.BITS).any() and lines.near_sketches(sketches[a], sketches[b : b + 1])[0]
    able = [k for k, line in enumerate(classes) if len(line) >= lines.ALONE]
    linked = [(classes[a], classes[b]) for a in able for b in able if a < b and meet(a, b) and lines.alike(classes[a], classes[b])]
    least = closed(classes, linked)
    first = {}
    for p in places:
        first.setdefault(least[p[4]], p[:4])
    return {p[:4]: first[least[p[4]]] == p[:4] for p in places}


def letter_variants(rng, count):
    base = " ".join(rng.choice(WORDS) for _ in range(90))
    return [base[:at] + rng.choice("xyz") + base[at + 1 :] for at in (rng.randrange(len(base)) for _ in range(count))]


def line_rows():
    rng = random.Random(7)
    pool = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    pool += letter_variants(rng, 30) + [p.upper() + "!" for p in pool[:10]] + ["", "...", "the " * 50 + "end", "the " * 49 + "end"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6))), "s") for i in range(80)]
    return rows + [(3, pool[0], "s"), (5, rows[5][1], "s"), (None, pool[1] + "\n" + pool[2], "s"), (200, None, "s"), (201, "", "s"), (202, "only\x0b " + "long " * 20000, "s")]


def test_line_groups(spark, docs_of):
    rows = line_rows()
    expected = line_truth(rows)
    got = {(r["id"] is not None, r["id"] or 0, r["row"], r["line"]): r["kept"] for r in lines.line_groups(docs_of(rows)).collect()}
    assert got == expected and 0 < sum(expected.values()) < len(expected)
    assert lines.line_groups(docs_of([])).collect() == []


def test_dedup_takes_lines_away(spark, docs_of):
    rows = line_rows()
    kept = line_truth(rows)
    docs = docs_of(rows)
    left = lines.dedup(docs)
    assert left.columns == docs.columns
    expected = []
    for i, text, _ in rows:
        own = [(x, kept.get((i is not None, i or 0, row_hash(text), n), True)) for n, x in enumerate((text or "").split("\n"))]
        after = "\n".join(x for x, keep in own if keep)
        if text is None or all(keep for _, keep in own):
            expected.append((i, text))
        elif any(lines.normal_lines(after)):
            expected.append((i, after))
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(map(str, expected))


def test_line_groups_find_edit_similarity(spark, docs_of):
    """Against edit similarity alone, at its very bound: nothing below it is linked, and most of what reaches it is."""
    rng = random.Random(8)
    rows, pairs = [], {}
    for low, high in ((100, 199), (200, 399), (400, 800)):
        for k in range(60):
            line = ""
            while len(line) < rng.randint(low, high):
                line += "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) + " "
            line = line.strip()
            most = int((1 - lines.SIMILARITY) * len(line) + 1e-9)
            for edits, apart in ((most, False), (5 * most + 5, True)):
                other = list(line)
                for at in rng.sample([i for i, c in enumerate(line) if c != " "], edits):
                    other[at] = "z"
                pairs[len(rows)] = (low, apart)
                rows += [(len(rows), f"{k} {low} {apart} {line}"[: len(line)], "s"), (len(rows) + 1, f"{k} {low} {apart} {''.join(other)}"[: len(line)], "s")]
    found = {r["id"]: r["first"]["id"] for r in lines.line_groups(docs_of(rows)).collect()}
    reached = {i: lines.alike(*(lines.normal_lines(rows[j][1])[0] for j in (i, i + 1))) for i in pairs}
    assert all(found[i + 1] == i + 1 for i in pairs if not reached[i])
    for low in (100, 200, 400):
        hits = [found[i + 1] == i for i, (size, apart) in pairs.items() if size == low and not apart and reached[i]]
        assert len(hits) > 50 and np.mean(hits) > 0.75, (low, np.mean(hits))


def test_equal_ids_meet_their_own_text_only(spark, docs_of):
    rows = [(None, f"{k} " + "some words that many lines of this text share " * 4, "s") for k in range(300)]
    docs = docs_of(rows)
    text = lines.F.col("text")
    given = docs.select(lines.F.col("doc_id").alias("id"), "text", lines.text_hash(text).alias("row"))
    wanted = given.select("id", "row", lines.F.lit(0).alias("line"), lines.F.xxhash64("row").alias("class"))
    plan = lines._texts(given, wanted)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("row#" in line and "hash#" in line for line in joins)
    assert lines._texts(given, wanted).count() == 300
    assert sum(r["kept"] for r in lines.line_groups(docs).collect()) >= 1
