"""Quality rules, line dedup, decontamination and near-duplicates against brute force, with hostile rows."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from alignlake.llm import decontaminate, line_dedup, quality_rules, setsketch
from alignlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}" for i in range(20_000))
HOSTILE = [
    (1, None), (2, ""), (3, " \t\n\x0b\f\r"), (4, "one"), (5, "the the the the the"), (6, "a b c a b c d\n\na b c\n#|$ x é😀"),
    (7, LONG), (7, LONG), (8, "same line here\nsame line here\nsame line here\n"), (9, "x\n" * 300), (10, "a\x1cb c\nd"),
]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"kept": F.lit("mine"), "items": F.lit(1), "n_words": F.lit("n"), "n_deleted": F.lit("d")}) if extra else df


def repeated(words):
    grams = list(zip(words, words[1:], words[2:]))
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g, n in __import__("collections").Counter(grams).items() if n > 1}
    return len({p for i, g in enumerate(grams) if g in twice for p in (i, i + 1, i + 2)})


def test_quality_counts_equal_brute_force(spark):
    rows = quality_rules.apply_rules(frame(spark, HOSTILE)).collect()
    assert len(rows) == len(HOSTILE)
    texts = dict(HOSTILE)
    for r in rows:
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeated(words)
        assert r.base_failed == (len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words))
        assert not (r.kept and r.base_failed)


def test_quality_rules_of_an_empty_table_and_a_custom_rule(spark):
    assert quality_rules.apply_rules(frame(spark, [])).count() == 0
    rule = quality_rules.Rule("few", "n_words", None, 3)
    row = quality_rules.apply_rules(frame(spark, [(1, "a b c")]), rules=(rule,)).first()
    assert row.ok_few and row.base_failed and not row.kept


def test_quality_plan_has_no_python(spark, capsys):
    quality_rules.apply_rules(frame(spark, HOSTILE)).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def brute_lines(rows, window, alone=None):
    """Lines after deleting every run, and every single line of ``alone`` words, that occurred before, rows by id then text."""
    seen, out = set(), []
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0], r[1] is not None)):
        if text is None:
            out.append((doc_id, None))
            continue
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for k in range(len(full) - window + 1):
            run = tuple(lines[i] for i in full[k : k + window])
            if run in seen:
                gone.update(range(full[k], full[k + window - 1] + 1))
            seen.add(run)
        for k in full:
            if alone is not None and len(WORD.findall(lines[k])) >= alone:
                gone |= {k} if lines[k] in seen else set()
                seen.add(lines[k])
        out.append((doc_id, "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


@pytest.mark.parametrize("window", [2, 3])
def test_line_dedup_equals_brute_force(spark, window):
    rnd = random.Random(window)
    rows = [(i, "\n".join(rnd.choice(["a", "b b", "c", "", "d"]) for _ in range(rnd.randint(0, 12)))) for i in range(100, 160)]
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "one line"), (8, "p\nq\np\nq\np\nq"), (9, "x\n" * 300), (10, "\n\n\n")]
    got = line_dedup.without_repeats(frame(spark, rows), window=window)
    assert got.columns == ["doc_id", "text", "kept", "items", "n_words", "n_deleted"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=lambda r: r[0]) == brute_lines(rows, window)


def test_long_lines_go_alone_between_differing_neighbours(spark):
    rnd = random.Random(5)
    passages = [" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (49, 50, 51, 60, 200)]
    rows = [(i, "\n".join(rnd.choice([*passages, f"own {rnd.random()}", "", "c", "d"]) for _ in range(rnd.randint(0, 9)))) for i in range(100, 160)]
    rows += [(1, None), (2, ""), (3, passages[3]), (4, passages[3]), (5, f"x {passages[4]}"), (6, f"p\n{passages[2]}\nq\n\n{passages[2]}\nr"), (7, passages[1].replace(" ", " \t"))]
    seen, want = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        lines, gone = (text or "").split("\n"), set()
        full = [i for i, x in enumerate(lines) if WORD.search(x)]
        for i, j in zip(full, [*full[1:], None]):
            if j is not None:
                gone |= set(range(i, j + 1)) if (lines[i], lines[j]) in seen else set()
                seen.add((lines[i], lines[j]))
            if len(WORD.findall(lines[i])) >= 50:
                gone |= {i} if lines[i] in seen else set()
                seen.add(lines[i])
        want.append((doc_id, None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    got = line_dedup.without_repeats(frame(spark, rows), alone=50).collect()
    assert sorted((r.doc_id, r.text) for r in got) == want
    assert sorted((r.doc_id, r.text) for r in line_dedup.without_repeats(frame(spark, rows)).collect()) == brute_lines(rows, 2)
    assert want[2] == (3, passages[3]) and want[3] == (4, "")


def test_line_dedup_of_equal_rows_null_ids_and_empty_tables(spark):
    rows = [(7, "u v\nw x\ny z"), (7, "u v\nw x\ny z"), (None, "u v\nw x"), (8, "y z\nu v\nw x")]
    got = sorted((r.doc_id or -1, r.text) for r in line_dedup.without_repeats(frame(spark, rows)).collect())
    assert got == [(-1, "u v\nw x"), (7, "y z"), (7, "y z"), (8, "y z")]  # the null id comes first and keeps the run
    assert line_dedup.without_repeats(frame(spark, [])).count() == 0


def test_masks_lose_no_allowed_pattern():
    picks = [[i for i, b in enumerate(m) if b == "1"] for m in decontaminate.MASKS]
    for n in range(decontaminate.LEAST, decontaminate.WINDOW + 1):
        window, allowed = decontaminate.tolerance(n)
        seen = [frozenset(o + p for p in m) for m in picks for o in range(window - m[-1])]
        assert all(any(not s & set(e) for s in seen) for e in itertools.combinations(range(window), allowed))


def brute_contaminated(text, items):
    words = re.findall(r"\w+", (text or "").lower())
    hit = set()
    for item_id, item in items:
        other = re.findall(r"\w+", (item or "").lower())
        if len(other) < decontaminate.LEAST:
            continue
        window, allowed = decontaminate.tolerance(len(other))
        for shift in range(-len(other), len(words)):
            same = [0 <= q + shift < len(words) and words[q + shift] == w for q, w in enumerate(other)]
            if any(sum(same[q : q + window]) >= window - allowed for q in range(len(other) - window + 1)):
                hit.add(item_id)
    return sorted(hit)


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(4)
    vocabulary = [f"t{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([3, 8, 9, 12, 15, 24, 40])))) for i in range(30)] + [(90, None), (91, ""), (92, "T1 t1 t1")]
    items += [(93, items[6][1]), (94, "la " * 30)]
    docs = [(1, None), (2, ""), (3, "la " * 500), (4, LONG)]
    for k, (_, item) in enumerate(items[:30]):
        words = item.upper().split()
        for swaps in (0, len(words) // 8, len(words) // 8 + 2):
            changed = list(words)
            for p in rnd.sample(range(len(words)), min(swaps, len(words))):
                changed[p] = "other"
            docs.append((100 + 10 * k + swaps, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 9)) + changed + rnd.choices(vocabulary, k=rnd.randint(0, 9))) + "!"))
    docs += [docs[-1], (docs[-1][0], "another text with the same id")]
    got = decontaminate.decontaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    rows = got.collect()
    assert len(rows) == len(docs) and set(got.columns) == {"doc_id", "text", "kept", "items", "n_words", "n_deleted"}
    for r in rows:
        want = brute_contaminated(r.text, items)
        assert (r["items"], r.kept) == (want, not want), r.doc_id


def test_decontamination_with_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.kept for r in decontaminate.decontaminated(frame(spark, [(1, "a b"), (None, None)]), none).collect()] == [True, True]
    assert decontaminate.decontaminated(frame(spark, []), none).count() == 0


def shingles(text, size):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_groups(rows, size, percent=80):
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {i: root(i) for i, _ in rows}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    rnd = random.Random(size)
    rows = [(1000 + i, t) for i, t in enumerate([None, "", " \t", "One", "one", "two", "a b", "A  b\n", "b a"])]
    key = 0
    for group in range(8):
        base = [f"g{rnd.randrange(4000)}" for _ in range(rnd.choice([30, 80, 200]))]
        for copy in range(rnd.choice([3, 12, 30])):
            words = list(base)
            for p in rnd.sample(range(len(base)), rnd.choice([0, 1, len(base) // 20, len(base) // 12])):
                words[p] = f"n{rnd.randrange(10**6)}"
            rows.append((key, " ".join(words)))
            key += 1
    chain = [f"c{i}" for i in range(120)]
    for step in range(15):  # each only like its neighbours
        rows.append((500 + step, " ".join(chain[2 * step : 2 * step + 80])))
    rows.append((600, LONG))
    got = {r.doc_id: r for r in setsketch.near_duplicates(frame(spark, rows), shingle=size).collect()}
    want = brute_groups(rows, size)
    for i, text in rows:
        assert got[i].n_shingles == len(shingles(text, size))
        assert got[i].component_id == want[i], i
        assert got[i].kept == (want[i] == i)


def test_near_duplicates_of_repeated_and_null_ids_and_an_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (None, None)]
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in setsketch.near_duplicates(frame(spark, rows)).collect())
    assert got == [(0, None, True), (0, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert setsketch.near_duplicates(frame(spark, [])).count() == 0


def test_helper_columns_take_names_that_no_column_has(spark):
    rows = [(1, "one line of eight words is long enough\nx"), (2, "one line of eight words is long enough\ny")]
    odd = {c: F.lit(f"mine {c}") for c in ("__parts", "parts", "__text_version", "text_version", "Row", "version", "lines", "doc", "found_items", "__items", "__doc")}
    df = frame(spark, rows, extra=False).withColumns(odd)
    items = spark.createDataFrame([("i", "eight words is long enough and more of it")], "item_id string, text string")
    for out in (quality_rules.apply_rules(df), line_dedup.without_repeats(df, alone=8), decontaminate.decontaminated(df, items)):
        assert all({r[c] for r in out.collect()} == {f"mine {c}"} for c in odd)
    assert [r.n_deleted for r in line_dedup.without_repeats(df, alone=8).orderBy("doc_id").collect()] == [0, 1]


def test_texts_of_one_id_share_a_component(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(5, a), (5, b), (3, f"{b} more"), (9, f"{a} more"), (7, c), (8, ""), (8, None), (5, "")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in setsketch.near_duplicates(frame(spark, rows)).collect()}
    assert got == {(5, 36): 3, (3, 37): 3, (9, 37): 3, (7, 36): 7, (8, 0): 8, (5, 0): 5}


def test_texts_that_share_a_template_never_meet(spark, monkeypatch):
    rnd, met, estimated = random.Random(11), [], setsketch.estimated
    template = [f"t{i}" for i in range(65)]
    rows = [(i, " ".join([*template, *(f"o{rnd.randrange(10**9)}" for _ in range(35))])) for i in range(2000)]
    for k in range(60):  # some of them with near copies
        words = rows[k][1].split()
        words[70] = "changed"
        rows.append((3000 + k, " ".join(words)))
    monkeypatch.setattr(setsketch, "estimated", lambda pairs, *rest: met.append(pairs.count()) or estimated(pairs, *rest))
    got = {r.doc_id: r.component_id for r in setsketch.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: i - 3000 if i >= 3000 else i for i, _ in rows}
    assert met[0] <= len(rows) and met[1] < 1000


def test_sketch_estimates_follow_the_similarity():
    rnd = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.8, 0.95):
        common = rnd.integers(0, 2**63, 400, dtype=np.uint64)
        extra = int(400 * (1 - share) / share / 2)
        a, b = (np.unique(np.concatenate([common, rnd.integers(0, 2**63, extra, dtype=np.uint64)])) for _ in range(2))
        regs = setsketch.registers(np.concatenate([a, b]), np.array([0, len(a)]), 336)
        got = setsketch.estimates(regs[:1], regs[1:], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(got - share) < 0.12
        merged = setsketch.registers(np.unique(np.concatenate([a, b])), np.array([0]), 336)
        assert (merged[0] == np.maximum(regs[0], regs[1])).all()


def test_block_comparison_counts_like_sets():
    rnd = random.Random(2)
    left, right = ([np.array(sorted(rnd.sample(range(300), rnd.randint(1, 60))), np.int64) for _ in range(9)] for _ in range(2))
    got = setsketch.common_counts(left, right)
    assert got.tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in right] for x in left]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(50, 90)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in [*range(50, 90), 100]} == {50} and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
