"""Fingerprints, secrets, toxicity and the whole pipeline on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401
import corpus_pipeline
from pricelake.llm import imatch, secrets, toxicity

WORDS = [a + b + c for a in "abcdefgh" for b in ("ra", "to", "mi") for c in ("lu", "ne", "so")]


SAMPLE = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_fingerprints(spark, docs_of):
    rng = random.Random(1)
    rare = [a + b for a in WORDS for b in WORDS]
    rows = [(i * 37, " ".join(rng.choice(rare) for _ in range(rng.randint(1, 300))), "s") for i in range(300)]
    rows += [(40000 + i, rows[0][1], "s") for i in range(120)] + [(99, None, "s"), (100, "", "s"), (101, "  ", "s"), (1, "é" * 5000, "s"), (None, "last one here", "s")]
    found = {r["doc_id"]: r for r in imatch.fingerprints(docs_of(rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for k, (i, text, _) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        q = len(text) // 4
        changed = text[: len(text) - q] + following[:q]
        assert found[i]["n_chars"] == len(text) and found[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
    same = {found[i]["fingerprint"] for i in [0, *range(40000, 40120)]}
    assert len(same) == 1
    near, far = (np.array([found[i][c] for i, t, _ in rows[:300] if len(t) > 400]) for c in ("near_edited", "near_next"))
    assert near.mean() > 0.3 and far.mean() < 0.15 and (near >= far).mean() > 0.9
    assert all(0 <= r[c] <= 1 for r in found.values() for c in ("near_edited", "near_next"))
    assert found[40000]["near_next"] == 1.0
    assert imatch.fingerprints(docs_of([])).collect() == []
    one = imatch.fingerprints(docs_of([(5, "a b c d e f g h", "s")])).first()
    assert one["near_next"] == 1.0


def test_fingerprints_count_words_of_long_texts_too(spark, docs_of):
    rng = random.Random(4)
    common, rare = [f"common{i}" for i in range(40)], [f"rare{i}" for i in range(400)]
    texts = [" ".join([*common, *(f"own{k}x{i}" for i in range(150)), *rng.sample(rare, 60)]) for k in range(100)]
    pairs = []
    for k in range(20):
        shared = " ".join(rng.sample(rare, 30))
        pairs.append(len(texts))
        texts += [f"{shared} {common[2 * k]}", f"{shared} {common[2 * k + 1]}"] * 2
    docs = docs_of([(i, text, "s") for i, text in enumerate([*texts, None])])
    most = 0.2  # 36 documents: above every rare word of the texts, below the common ones
    held = Counter(w for text in texts for w in set(text.split()))
    numbers = {r["h"]: r["w"] for r in spark.createDataFrame([(w,) for w in held], "w string").selectExpr("w", "xxhash64(w) h").collect()}
    assert {numbers[r["h"]]: r["n"] for r in imatch.frequencies(docs).collect()} == {w: n for w, n in held.items() if n >= 2}
    assert all(held[w] > most * (len(texts) + 1) for w in common) and sum(held[w] <= most * len(texts) for w in rare) > 300
    found = {r["doc_id"]: r["fingerprint"].split(",") for r in imatch.fingerprints(docs, most=most).collect() if r["fingerprint"]}
    parts = slice(0, imatch.DRAWS * (imatch.LONG + imatch.BRIEF))
    assert all(found[i][parts] == found[i + 1][parts] and any(found[i][parts]) for i in pairs)  # the common word is no term


def plain_spans(text):
    """The three patterns as given, match by match."""
    out = [(m.start(), m.end(), "assign") for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))


def test_base_spans_are_the_patterns():
    rng = random.Random(2)
    parts = ["password", "PassWD", "toKen", "api_key", "apikey", "ſecret", "toKen", "=", ":", " ", "'", '"', "abc", "deadbeef", "AKIA", "ABCD1234", "0123456789ab", "\n", "é", "_", ".", "-"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        assert secrets.base_spans(text) == plain_spans(text), text


def secret_rows(rng):
    rows = []
    for i in range(400):
        text = prose(rng, 30)
        if i % 5 == 0:
            key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            text += rng.choice([f' token = "{key}" ', f" password={key[:18]} ", " AKIA" + key[:16].upper() + " "]) + prose(rng, 20)
        if i % 7 == 0:
            text += f" {rng.choice('abc')}x.{i}@mail.example.com +1 555 01{i}"
        rows.append((i, text, "s"))
    return rows + [(900, None, "s"), (901, "", "s"), (902, "x " * 40000, "s"), (0, rows[0][1], "s"), (None, "passwd: abcdefgh", "s")]


def test_scan_keeps_the_base_and_learns_its_lines(spark, docs_of):
    rows = secret_rows(random.Random(3))
    docs = docs_of(rows)
    found = secrets.report(secrets.scan(docs)).collect()
    assert len(found) == len(rows)
    texts = {i: t or "" for i, t, _ in rows}
    for r in found:
        base = plain_spans(texts[r["doc_id"]])
        counts = Counter(k for _, _, k in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(counts[k] for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert {f"{k}:{a}:{b}" for a, b, k in base} <= set(spans) and len(spans) == len(base) + r["n_tagged"]
    field = secrets.Field.fit(secrets.sample_lines(docs.select("text"), 100))
    tagger = secrets.Tagger(field)
    hit = [any(a < e and b > s for a, b in tagger(texts[i])) for i in range(0, 400, 5) for s, e, _ in plain_spans(texts[i])[:1]]
    assert np.mean(hit) > 0.9
    assert np.mean([bool(tagger(texts[i])) for i in range(400) if i % 5]) < 0.1
    assert secrets.report(secrets.scan(docs_of([]))).collect() == []
    assert secrets.report(secrets.scan(docs_of([(1, "no such thing", "s")]))).first()["spans"] == ""


def test_viterbi_and_pruning_are_exact():
    rng = np.random.default_rng(4)
    field = secrets.Field.fit([secrets._example(t, 0, t, plain_spans(t)) for t in ("a b password=abcdefgh c", "x token = abcdefghij y", "plain words here", "mail a@b.c 12")])
    for _ in range(200):
        emit = rng.normal(size=(rng.integers(1, 6), 3))
        best = max(np.ndindex(*[3] * len(emit)), key=lambda p: emit[range(len(p)), p].sum() + sum(field.moves[a, b] for a, b in zip(p, p[1:])) - 30 * (p[0] == 2))
        assert tuple(secrets.viterbi(emit, field.moves)) == best
    tagger = secrets.Tagger(field)
    for text in ("a b password=abcdefgh c\nplain words", "x token = abcdefghij y", "nothing\n\nto see", "mail a@b.c 12"):
        kept = tagger(text)
        tagger.slack = 1e9  # decode every line
        assert tagger(text) == kept
        tagger.slack = 2 * max(0.0, float((field.moves - field.moves[0, 0]).max()))


def toxic_rows(rng, n=500):
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = prose(rng, rng.randint(5, 80)).split()
        if bad:
            for w in rng.choices(["idiot", "clown", "lostraan", "lostrabe", "lostrazu"], k=rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), w)
        docs.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_held_out(spark, docs_of):
    docs, labels = toxic_rows(random.Random(5))
    docs += [(900, None, "s"), (901, "", "s"), (902, "calm " * 30000, "s"), (0, docs[0][1], "s"), (None, "idiot clown", "s")]
    frame, marks = docs_of(docs), spark.createDataFrame([*labels, (0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(frame, marks)
    assert {"idiot", "clown", "lostra*"} <= set(model.grammar.lexicon)
    got = toxicity.score(frame, model).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got) and len(got) == len(docs)
    clean = toxicity.keep_clean(frame, model)
    assert clean.columns == frame.columns and clean.count() == sum(r["predicted"] == 0 for r in got)
    assert toxicity.learn(frame, marks.limit(0)) is None
    assert {r["score"] for r in toxicity.score(frame, None).collect()} == {0.0}
    assert toxicity.score(docs_of([]), model).collect() == []


def test_grammar_scores_clauses_and_not_words():
    grammar = toxicity.Grammar({"idiot": 4.0, "lostra*": 4.0})
    score = lambda text: sum(grammar.clause_scores(text, grammar.symbols()))
    assert score("you are an idiot") > score("an idiot") > score("you are not an idiot") > 0
    assert score("they said an idiot came") < score("an idiot came") and score("he. LOSTRAzu") == 4.0
    assert score("we burn wood") == 0.0 < score("we will burn you") or score("you we will burn") > 0
    assert score("not here at all today, idiot") == 4.0 and score("") == 0.0


def test_pipeline(spark, docs_of, tmp_path):
    rng = random.Random(6)
    docs, labels = toxic_rows(rng, 200)
    copy = "\n".join(prose(rng, 20) for _ in range(8))
    near = [copy.replace(WORDS[k], "new" + WORDS[k], 1) for k in range(20)]
    docs += [(1000 + k, t, "b") for k, t in enumerate(near)] + [(2000, copy, None), (2001, copy, "c"), (2002, None, "c"), (2003, "", "c")]
    frame = docs_of(docs)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept, names = spark.read.parquet(f"{tmp_path}/documents.parquet"), [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard", "mix_sources", "pack"]
    seen = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, str(tmp_path))
        out.write.parquet(f"{tmp_path}/out-{number}")
        kept = spark.read.parquet(f"{tmp_path}/out-{number}")
        seen[name] = kept
        if number < 4:
            assert kept.columns == frame.columns
            assert kept.where("n_chars <=> length(text)").count() == kept.count()
    bad = {i for i, _, t in labels if t}
    left = {r["doc_id"] for r in seen["toxicity"].collect()}
    assert len(left & bad) < 0.1 * len(bad) and {i for i, _, _ in docs} - bad <= left | {None}
    assert {2002, 2003} <= {r["doc_id"] for r in seen["ngram_jaccard"].collect()}
    copies = [r["doc_id"] for r in seen["ngram_jaccard"].collect() if r["doc_id"] in (2000, 2001)]
    assert copies == []  # all their lines stand in earlier documents
    assert seen["pack"].agg({"length": "max"}).first()[0] <= 2048
    empty = corpus_pipeline.drop_near_copies(spark, docs_of([]), str(tmp_path))
    assert empty.collect() == [] and empty.columns == frame.columns
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_repeated_lines, corpus_pipeline.mix_sources, corpus_pipeline.pack_sequences):
        assert stage(spark, docs_of([]), str(tmp_path)).collect() == []


def test_registered_queries(spark):
    from oracle_check import connect, difference
    from pricelake.llm.queries import ORACLES, QUERIES

    con = connect(SAMPLE)
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 11)]
    for name, text in ORACLES.items():
        assert difference(QUERIES[name](spark, SAMPLE), con, text) is None, name
    for name in ("op4_chat_format", "op7_lattice_near_dedup", "op9_toxicity"):
        assert QUERIES[name](spark, SAMPLE).count() > 0


def test_native_operators_run_no_python(spark):
    from pricelake.llm.queries import QUERIES

    for name in ("op3_mix_sources", "op5_imatch_fingerprints"):
        plan = QUERIES[name](spark, SAMPLE)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


if __name__ == "__main__":
    pytest.main([__file__])


def test_composed_machine_is_both_in_turn():
    first, second = toxicity.scope(), toxicity.scorer()
    both = toxicity.compose(first, second)
    rng = random.Random(5)
    symbols = (toxicity.OTHER, toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.THING)
    for _ in range(400):
        a, b, c = first.start, second.start, both.start
        for symbol in rng.choices(symbols, k=rng.randint(1, 25)):
            a, out = first.step[a, symbol]
            b, weight = second.step[b, out]
            c, found = both.step[c, symbol]
            assert (a, b) == c and weight == found


def test_threats_need_an_object_and_refuse_is_literal():
    grammar = toxicity.Grammar({"idiot": 4.0, "trash": 4.0, "moron": 5.0})
    total = lambda text: sum(grammar.clause_scores(text, grammar.symbols()))
    assert grammar.threat == 4.0 and total("I will kill you.") == total("They will hurt him") == 6.0
    assert total("to kill time") == total("we beat eggs; you cook") == total("Please empty the trash can.") == 0
    assert 0 < total("I will not kill you") < total("He said he would kill you") < 6.0
    assert total("you are trash") == 6.0 and total("trash") == 4.0


def test_a_word_does_not_lend_its_beginning(spark, docs_of):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(300):
        words = prose(rng, 20).split()
        if i % 3 == 0:
            words.insert(5, rng.choice(["pathetic", "worthless", "trash", *(f"zoubl{e}" for e in ("a", "on", "ette", "ir"))]))
        rows.append((i, " ".join(words), "s"))
        marks.append((i, int(i % 3 == 0)))
    frame = docs_of(rows)
    model = toxicity.learn(frame, spark.createDataFrame(marks, "doc_id long, toxic int"))
    texts = ["The path to the station is short.", "It is worth the money.", "A study of pathology.", "Please empty the trash can.", "how pathetic", "zoublard", "I will kill you.", ""]
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs_of([(i, t, "s") for i, t in enumerate(texts)]), model).collect()}
    assert max(found[i] for i in (0, 1, 2, 3, 7)) < 0.5 < min(found[i] for i in (4, 5, 6))
