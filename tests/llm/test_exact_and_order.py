"""Exact dedup, sharding, repeated passages, quality and the language model beside plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from statloom.llm import exact_dedup, lm, quality, repeats, sharding

FOLD = re.compile(r"[\x20\x09-\x0D]+")


def folded(text):
    return FOLD.sub(" ", text or "")


def test_exact_groups(make_docs, odd_docs):
    random.seed(1)
    base = [" ".join(random.choices(["one. ", "two", "three!\n", "four"], k=random.randint(0, 400))) for _ in range(20)]
    rows = [(i, random.choice(base).replace(" ", random.choice([" ", "  ", "\t"]))) for i in range(120)]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[folded(t)].append(i)
    want = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    got = exact_dedup.exact_groups(make_docs(rows), least=20, most=60).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    odd = exact_dedup.exact_groups(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    by_text = {r.text_sha256: r for r in odd if r.doc_id is not None}
    assert by_text[hashlib.sha256(b"").hexdigest()].keep_id == 0
    assert by_text[hashlib.sha256(b"word").hexdigest()].group_size == 2


def test_chunks_are_the_text_and_fall_into_step(spark):
    random.seed(2)
    sentences = [" ".join(random.choices(["alpha", "beta", "gamma"], k=random.randint(2, 30))) + ". " for _ in range(300)]
    long, changed = "".join(sentences), "".join(["new start! ", *sentences])
    rows = spark.createDataFrame([(long,), (changed,), ("z" * 9000,), ("",)], "text string").select("text", exact_dedup.chunks_of(F.col("text")).alias("c")).collect()
    assert all("".join(r.c) == r.text for r in rows)
    assert len(set(rows[0].c) & set(rows[1].c)) > 0.5 * len(rows[0].c)


def test_collisions_are_found(spark):
    rows = [((1, 2), "a"), ((1, 2), "a"), ((1, 2), "b"), ((3, 4), "c")]
    chunks = spark.createDataFrame(rows, "chunk_id struct<a:long,b:long>, chunk string")
    assert [tuple(r.chunk_id) for r in exact_dedup.unverified(chunks).collect()] == [(1, 2)]


def test_drop_copies(make_docs, odd_docs):
    kept = exact_dedup.drop_copies(make_docs([(5, "a  b"), (2, "a b"), (9, "c"), (9, "c"), (7, None), (8, "")]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 9]
    odd = exact_dedup.drop_copies(odd_docs).collect()
    assert len(odd) == len({folded(r.text) for r in odd_docs.collect()})
    assert exact_dedup.drop_copies(make_docs([])).count() == 0


def test_sharding(make_docs, odd_docs):
    docs = make_docs([(i, "t" * (i % 50)) for i in range(2000)]).withColumn("shard", F.lit("clash"))
    got = sharding.shuffled_shards(docs, bucket_bytes=8000).collect()
    assert sorted(r.doc_id for r in got) == list(range(2000))
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(250))
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.shuffled_shards(docs.repartition(7), bucket_bytes=8000).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in got}
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.slot, r.shard))]
    n = 2000
    spearman = 1 - 6 * sum((i - x) ** 2 for i, x in enumerate(order)) / (n * (n * n - 1))
    assert abs(spearman) < 0.1
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20
    assert sharding.shuffled_shards(odd_docs).count() == odd_docs.count()
    assert sharding.shuffled_shards(make_docs([])).count() == 0


def test_written_shards(make_docs, spark, tmp_path):
    sharded = sharding.shuffled_shards(make_docs([(i, f"text {i}") for i in range(100)]), shards=4)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.text, r.shard, r.slot) for r in back.collect()} == {(r.doc_id, r.text, r.shard, r.slot) for r in sharded.collect()}


def plain_repeats(rows, least=5):
    """All units in rank order, one after the other."""
    seen, removed = set(), collections.defaultdict(list)
    for key, text in sorted(rows):
        for m in re.finditer(r"[^\n.!?]*[.!?]*\n?", text or ""):
            flat = " ".join(re.findall(r"[^\x20\x09-\x0D]+", m.group().lower()))
            if len(flat.split(" ")) >= least and flat:
                if flat in seen:
                    removed[key].append(m.span())
                seen.add(flat)
    return removed


def plain_runs(rows, least_run=20):
    """Units with words in rank order; of those seen before, the ones whose neighbours have enough words together."""
    seen, removed = set(), {}
    for key, text in sorted(rows):
        run, gone = [], []
        for m in [*re.finditer(r"[^\n.!?]*[.!?]*\n?", text or ""), None]:
            flat = " ".join(re.findall(r"[^\x20\x09-\x0D]+", m.group().lower())) if m else "\n"
            if flat in seen:
                run.append((m.span(), len(flat.split(" "))))
            elif flat:
                gone += [span for span, _ in run] if sum(n for _, n in run) >= least_run else []
                run = []
                if m:
                    seen.add(flat)
        removed[key] = gone
    return removed


def test_repeated_lines_and_paragraphs_of_enough_words_go_whole(make_docs):
    line = "a line with Mr. Smith and No. 5. It has ten words! And more? Yes, so many more that all of it goes from here."
    paragraph = "\n".join(["short one", "and two", "", *(f"line {i} of a list" for i in range(6))]) + "\n"
    chance = "this sentence repeats by chance alone.\n"
    rows = [(1, f"{line}\n{chance}{paragraph}end\n"), (2, f"other\n{chance}own words\n{line}\nown again\n{paragraph}"), (3, f"x {line}\n")]
    cut = {r.doc_id: r.text for r in repeats.remove_repeats(make_docs(rows)).collect()}
    assert cut == {1: rows[0][1], 2: f"other\n{chance}own words\nown again\n\n", 3: cut[3]}
    assert cut[3].startswith("x a line with Mr.") and len(cut[3]) < 30


def test_repeated_keys_and_clashing_names(make_docs):
    line = " ".join(f"w{i}" for i in range(25)) + ".\n"
    rows = [(1, line + "one own text\n"), (1, "quite another text without any repeat at all"), (1, "head\n" + line), (None, line), (None, line), (2, None)]
    names = {"_id": 1, "row": 2, "done": 3, "at": 4, "removed": 5, "digest": 6, "words": 7, "first": 8}
    docs = make_docs(rows).selectExpr("*", *[f"{v} AS {k}" for k, v in names.items()])
    got = repeats.remove_repeats(docs).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted([(1, "one own text\n"), (1, rows[1][1]), (1, "head\n"), (0, line), (0, line), (2, "")])
    assert all([r[k] for k in names if k != "removed"] == [v for k, v in names.items() if k != "removed"] for r in got)
    assert [r.text for r in got if r.doc_id == 2] == [None]
    assert repeats.remove_repeats(docs, lines=True).count() == len(rows)


def test_repeated_passages(make_docs, odd_docs):
    random.seed(4)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(" ".join(random.choices(words, k=12)) + "." for _ in range(6))
    rows = []
    for i in range(60):
        own = [" ".join(random.choices(words, k=random.randint(1, 9))).capitalize() + random.choice([".", "!", "\n"]) for _ in range(10)]
        if i % 3 == 0:
            own.insert(random.randint(0, 9), passage)
        rows.append((i, " ".join(own)))
    want = plain_repeats(rows)
    got = {r.doc_id: [(x.start, x.end) for x in r.removed] for r in repeats.repeated_spans(make_docs(rows), least_words=5, least_run=0).collect()}
    assert got == {i: want.get(i, []) for i, _ in rows}
    assert sum(i % 3 == 0 and len(got[i]) >= 6 for i, _ in rows) == 19  # all but the first
    cut = {r.doc_id: r.text for r in repeats.remove_repeats(make_docs(rows), least_words=5, least_run=0).collect()}
    for i, t in rows:
        assert cut[i] == repeats.without_spans(t, want.get(i, []))
    want = plain_runs(rows)
    got = {r.doc_id: [(x.start, x.end) for x in r.removed] for r in repeats.repeated_spans(make_docs(rows)).collect()}
    assert got == {i: want.get(i, []) for i, _ in rows}
    assert all(len(got[i]) >= 6 for i, _ in rows if i % 3 == 0 and i)
    assert repeats.repeated_spans(odd_docs).count() == odd_docs.count()
    assert repeats.repeated_spans(make_docs([])).count() == 0


def test_repeated_lines_go_whole(make_docs):
    rows = [
        (1, "Thth atouen and thwhedble. Ti.\nENERAT!! ONOUTION.!! AT!! IN!! THE!!\nown words of one. No.\n"),
        (2, "other words at first here\nThth atouen and thwhedble. Ti.\nENERAT!! ONOUTION.!! AT!! IN!! THE!!\nlast one, mine.\n"),
        (3, "Yes.\nNo.\nWhy so?\nGo on.\n\nmine alone are these words\n"),
        (4, "this line is only here\n\nYes.\nNo.\nWhy so?\nGo on.\n"),
        (5, "one two three four five. So! six seven eight nine ten.\n"),
        (6, "new start. one two three four five. Ah! six seven eight nine ten. new end.\n"),
        (7, "Start here. It is! No! But yes! Or not. and a tail of five words.\n"),
        (8, "Now a head of five words. It is! No! But yes! Or not.\n"),
    ]
    cut = {r.doc_id: r.text for r in repeats.remove_repeats(make_docs(rows), lines=True).collect()}
    assert [cut[i] for i in (1, 3, 5, 7)] == [rows[i - 1][1] for i in (1, 3, 5, 7)]
    assert cut[2] == "other words at first here\nlast one, mine.\n"
    assert cut[4] == "this line is only here\n\n"
    assert cut[6] == "new start. new end.\n"
    assert cut[8] == rows[7][1]  # the run of 7 begins earlier, so it is another one
    assert "Ti." in {r.doc_id: r.text for r in repeats.remove_repeats(make_docs(rows), least_words=5, least_run=0).collect()}[2]
    again = [(i, t) for i, t in cut.items()]
    assert {r.doc_id: r.text for r in repeats.remove_repeats(make_docs(again), lines=True).collect()} == cut


def test_units_are_the_text():
    for text in ["", "\n", "a.b!c?\nd", "no end", "...", "é!\n\n x"]:
        assert "".join(text[s:e] for s, e, _, _ in repeats.units_of(text)) == text


def plain_scores(texts, least=2, backoff=0.4):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    one, two = collections.Counter(w for d in docs for w in d), collections.Counter(p for d in docs for p in zip(d, d[1:]))
    n = sum(one.values())
    out = []
    for d in docs:
        total = 0.0
        for i, w in enumerate(d):
            pair = two[(d[i - 1], w)] if i else 0
            total += math.log(pair / one[d[i - 1]]) if pair >= least else math.log(one[w] / n) + (math.log(backoff) if i else 0)
        out.append((len(d), round(total, 6)))
    return out


def test_backoff_scores(make_docs, odd_docs):
    random.seed(5)
    texts = [" ".join(random.choices("the of and A a cat dog".split(), k=random.randint(0, 40))) for _ in range(80)] + [None, ""]
    got = lm.scored(make_docs(list(enumerate(texts))), block_bytes=3000).collect()
    assert [(r.n_words, round(r.log_score, 6)) for r in sorted(got, key=lambda r: r.doc_id)] == plain_scores(texts)
    assert lm.scored(odd_docs).count() == odd_docs.count()
    assert lm.scored(make_docs([])).count() == 0


def plain_measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if tri[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(hit)


def test_measures():
    random.seed(6)
    for _ in range(500):
        text = "".join(random.choices(["a ", "b ", "c ", "\n", "#|", "é", "\t", "\x1c", "\xa0"], k=random.randint(0, 60)))
        assert quality.measure(text) == plain_measure(text)


def test_quality_adapts_to_the_source(make_docs, odd_docs):
    random.seed(7)
    word = lambda: "".join(random.choices("abcdefghijklmnop", k=5))
    rows = []
    for i in range(900):
        marks = " ##" if i % 3 == 0 else ""  # source 0 writes like that throughout
        rows.append((i, " ".join(word() + marks for _ in range(80)), "en", f"s{i % 3}", None))
    rows += [(900, " ".join(word() + " ##" for _ in range(80)), "en", "s1", None), (901, "few words", "en", "s1", None)]
    rows += [(902, "same three words " * 60, None, None, None)]
    got = {r.doc_id: r for r in quality.judged(make_docs(rows)).collect()}
    assert all(got[i].kept for i in range(900))
    assert not got[900].kept and not got[900].base_failed
    assert got[901].base_failed and got[902].base_failed and not got[902].kept
    assert quality.judged(odd_docs).count() == odd_docs.count()
    assert quality.judged(make_docs([])).count() == 0


def test_own_thresholds_tighten_the_fixed_cuts(make_docs):
    random.seed(9)
    word = lambda: "".join(random.choices("abcdefghijklmnop", k=5))
    line = lambda: " ".join(word() for _ in range(10))
    rows = [(i, "\n".join(line() for _ in range(10)), "en", "s", None) for i in range(300)]
    again = line()
    rows += [(300, "\n".join([*(line() for _ in range(7)), *[again] * 4]), "en", "s", None)]  # under half of its lines repeat
    rows += [(301, " ".join(word() + "abc" for _ in range(80)), "en", "s", None)]  # mean length 8
    docs = make_docs(rows)
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == set(range(300))
    assert {r.doc_id for r in quality.keep_good(docs, own=False).collect()} == set(range(302))
    named = docs.selectExpr("*", "1 AS kept_id", "2 AS _kept_id")
    assert quality.keep_good(named).columns == named.columns


def test_quantiles_of_sketches(spark):
    random.seed(8)
    values = [random.lognormvariate(0, 1) for _ in range(3000)] + [0.0] * 500
    rows = spark.createDataFrame([(v, "g", "h") for v in values], "x double, lang string, source string")
    rows = rows.select("lang", "source", *[F.col("x").alias(m) for m in quality.MEASURES])
    parts = quality.sketches(rows.where("symbol_share < 1"), ("lang",)).unionByName(quality.sketches(rows.where("symbol_share >= 1"), ("lang",)))
    got = quality.quartiles(quality.merged(parts, ("lang",)), ("lang",)).first()
    values.sort()
    assert got.q1 == pytest.approx(values[len(values) // 4], rel=0.03)
    assert got.q3 == pytest.approx(values[3 * len(values) // 4], rel=0.03)
    assert got["rows"] == 3500


def test_crc_of_text(spark):
    assert spark.sql("SELECT crc32(encode('é', 'UTF-8'))").first()[0] == zlib.crc32("é".encode())
