"""Personal data, languages, secrets, token files, pieces and pages against brute force, libraries and held-out rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from alignlake.llm import language_id, page_text, personal_data, piece_codec, secret_ledger, token_files
from alignlake.session import work_path

TOKENIZERS = "/opt/tokenizers"
CLASH = {"spans": "s", "score": "x", "findings": 1, "decoded": 2, "lang": "zz"}


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()}) if clash else df


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def base_personal(text):
    text, spans = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    spans += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def fuzz(alphabet, count, seed, size=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, size))) for _ in range(count)]


def test_base_personal_data_equals_the_plain_expressions(spark):
    texts = fuzz(["a", "@", ".", "b.c", "1", "22", "-", " ", "+", "(", "x@y.z", "4785380592391139", "1.2.3.4", "é"], 3000, 1)
    texts += [None, "", "a@b.c_d@e.f@g.h", "9" * 3000, "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.255", "+1 (743) 555-3824", "日本 a@b.de"]
    got = personal_data.digest(personal_data.find(frame(spark, list(enumerate(texts))))).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base_personal(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[r.doc_id]
        assert set(want.split(",")) <= set(r.spans.split(",")) or not want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(f"{k}:") for s in want.split(",")) for k in personal_data.KINDS]


def test_the_field_adds_tied_numbers_and_leaves_clean_text_alone():
    rnd = random.Random(2)
    number = lambda: f"({rnd.randint(200, 899)}) 555-{rnd.randint(1000, 9999)}"
    texts = [f"word the +1 {number()} of version 2.0. and {rnd.randint(1, 99)} more" for _ in range(60)]
    texts += [f"some m{i}.x@mail.example.com or {rnd.randint(1, 254)}.{rnd.randint(0, 254)}.3.4 in 2024" for i in range(60)]
    model = personal_data.train(personal_data.Graph(texts, [personal_data.base_spans(t) for t in texts]))
    probe = ["call +1 (743) 555-3824 and later (743) 555-3824 again", "License, version 2.0. of 12 and 2024 and 17", ""]
    base = [personal_data.base_spans(t) for t in probe]
    added = personal_data.added_spans(probe, base, model)
    assert [(k, probe[0][a:b]) for k, a, b in added[0]] == [(3, "(743) 555-3824")] and added[1:] == [[], []]
    assert personal_data.added_spans(probe, base, None) == [[], [], []]


def test_every_mention_of_an_observed_number_is_tied_to_it():
    n = personal_data.LABELS
    model = {"node": np.zeros((personal_data.FEATURES, n)), "chain": np.zeros((n, n)), "skip": 5 * np.eye(n)}
    probe = ["call +1 (743) 555-3824 " + "and then 555-3824 or " * 40, "555-3824 and 555-3824 then +1 (743) 555-3824",
             "now +17435553824 or 555-3824 or 17435553824 it is", "only 555-3824 and 555-3824 here"]
    base = [personal_data.base_spans(t) for t in probe]
    added = personal_data.added_spans(probe, base, model)
    assert [len(x) for x in added] == [40, 2, 2, 0]
    assert all((k, probe[i][a:b]) in {(3, "555-3824"), (3, "17435553824")} for i, x in enumerate(added) for k, a, b in x)
    alone = [personal_data.added_spans([t], [b], model)[0] for t, b in zip(probe, base, strict=True)]
    assert alone == added  # whatever else is in the batch


def test_propagation_is_exact_on_a_tree():
    text = ["call 5551234 12 +1 now 5551234"]
    graph = personal_data.Graph(text, [[]])
    rnd = np.random.default_rng(0)
    n = personal_data.LABELS
    model = {"node": rnd.normal(size=(personal_data.FEATURES, n)), "chain": rnd.normal(size=(n, n)), "skip": rnd.normal(size=(n, n))}
    model["skip"] = model["skip"] + model["skip"].T
    graph.can[:] = True
    own = graph.design() @ model["node"]
    weight = np.zeros([n] * len(own))
    for index in np.ndindex(*weight.shape):
        weight[index] = sum(own[i, label] for i, label in enumerate(index))
        weight[index] += sum(model["chain"][index[i], index[j]] for i, j in graph.chain) + sum(model["skip"][index[i], index[j]] for i, j in graph.skip)
    p = np.exp(weight - weight.max())
    p /= p.sum()
    got = personal_data.posteriors(graph, model)
    for i in range(len(own)):
        assert np.allclose(got[i], p.sum(axis=tuple(k for k in range(len(own)) if k != i)), atol=1e-2)


def test_personal_data_of_an_empty_table(spark):
    assert personal_data.find(frame(spark, [])).count() == 0


def base_secrets(text):
    text, found = text or "", []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text, re.IGNORECASE | re.ASCII) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_secrets_equal_the_plain_expressions_and_copies_share_one_scan(spark):
    texts = fuzz(["token", "API_KEY", "Secret", "=", ":", " ", '"', "abcdef", "0123456789ab", "AKIA", "ABCDEFGH12345678", "x.y", "ſecret", "é"], 1500, 3, 14)
    texts += [None, "", "AKIA" * 10, "f" * 5000, "token==abcdef", "-----BEGIN RSA PRIVATE KEY-----"] + ["password = hunter22"] * 40
    docs = frame(spark, list(enumerate(texts)))
    ledger = work_path(spark, "ledger-test")
    first = secret_ledger.incremental_scan(docs, ledger)
    for r in secret_ledger.digest(first).collect():
        want = base_secrets(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[r.doc_id]
        assert not want or set(want.split(",")) <= set(r.spans.split(","))
    assert spark.read.parquet(ledger).count() == len({t or "" for t in texts})
    more = docs.unionByName(frame(spark, [(9000, "token: newone"), (9001, "password = hunter22"), (1, "a second version of 1 with secret=abcdef")]))
    assert secret_ledger.scan(more, ledger).count() == 2  # only what this rule version has not seen
    found = {(r.doc_id, len(r.findings)) for r in secret_ledger.found_in_paths(more, ledger).filter("doc_id >= 9000 OR doc_id = 1").collect()}
    assert {(9000, 1), (9001, 1), (1, 1)} <= found
    assert secret_ledger.scan(more, ledger).count() == 0
    assert secret_ledger.scan(docs, ledger, version="other").count() == len({t or "" for t in texts})


def test_secrets_of_an_empty_table(spark):
    assert secret_ledger.incremental_scan(frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def encoder():
    with open(f"{TOKENIZERS}/word_bpe_49k.json", encoding="utf-8") as f:
        return token_files.TextIds(f.read())


def test_word_by_word_ids_equal_the_library(encoder):
    texts = fuzz("aBcdéÉßİıŸſK's'tt́̇Σσς日本1²ªº<|>.,--''_  \n\t\x1c\x85　\xa0😀ẖHǅ", 3000, 5, 40)
    texts += [None, "", " ", "<|endoftext|>", "a<|endoftext|> <|startoftext|>b", "it's we'll don't rock'n'roll the'", "x" * 3000, "the, of. " * 3000]
    ids, sizes = encoder.encode(pa.array(texts))
    want = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [e.ids for e in want]


def test_token_files_round_trip(spark, encoder):
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choices(["The", "cat,", "sät", "日本", "x1"], k=rnd.randint(0, 30)))) for i in rnd.sample(range(10**6), 200)]
    rows += [(-5, None), (-4, ""), (-3, "a b"), (-3, "a b"), (None, "sät"), (None, "sät"), (None, "sät")]
    manifest = token_files.write_tokens(frame(spark, rows), f"{TOKENIZERS}/word_bpe_49k.json", 1)
    got = token_files.read_tokens(manifest, lambda ids: {"all": ids.tolist(), "crc": zlib.crc32(ids.astype("<u4").tobytes())}, "all array<bigint>, crc bigint")
    at = 0
    for r, (doc_id, text) in zip(sorted(got.collect(), key=lambda r: r.start), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), strict=True):
        want = [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r["all"]) == (doc_id, at, len(want), want)
        at += len(want)
    hot = [(7, f"text {i}") for i in range(300)]
    manifest = token_files.write_tokens(frame(spark, hot), f"{TOKENIZERS}/word_bpe_49k.json", 1)
    assert manifest.count() > 1 and token_files.read_tokens(manifest, token_files.ids_crc32, "ids_crc32 bigint").count() == 300
    part = manifest.first()
    assert np.memmap(part.ids_file.removeprefix("file:"), "<u2").size == part.ids
    empty = token_files.write_tokens(frame(spark, []), f"{TOKENIZERS}/word_bpe_49k.json", 1)
    assert token_files.read_tokens(empty, token_files.ids_crc32, "ids_crc32 bigint").count() == 0


@pytest.fixture(scope="module")
def codec():
    with open(f"{TOKENIZERS}/piece_bpe_32k.model", "rb") as f:
        data = f.read()
    import sentencepiece

    return piece_codec.Codec(piece_codec.Model(data)), sentencepiece.SentencePieceProcessor(model_proto=data)


def test_pieces_equal_the_library(codec):
    own, library = codec
    texts = fuzz("aaabbbee  tthh \n\t▁éü日本語😀'\"--..0011<>x", 2000, 7)
    texts += ["", " ", "  ", "a" * 5000, "\n" * 50, " " * 100 + "x", "the " * 5000, "<s> </s> <unk> <0x41>", "\u0000", "ﬁ", "and　b", "antidisestablishmentarianism" * 40]
    got = own.encode(texts)
    assert [g.tolist() for g in got] == library.encode(texts)
    assert [own.decode(g) for g in got] == [library.decode(g.tolist()) for g in got]


def test_pairs_of_pieces_are_compatible_when_merging_keeps_them(codec):
    own, _ = codec
    m, rnd = own.model, np.random.default_rng(3)
    ids = np.array([i for i in m.piece.values() if len(m.names[i]) < 6])
    a, b = rnd.choice(ids, 3000), rnd.choice(ids, 3000)
    want = [m.merged(m.names[x] + m.names[y]) == [x, y] for x, y in zip(a, b, strict=True)]
    assert m.compatible(a, b).tolist() == want


def test_pieces_of_a_table(spark):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (3, ""), (4, "ünïcode 日本 😀"), (5, "word " * 20_000)]
    got = piece_codec.with_pieces(frame(spark, rows), f"{TOKENIZERS}/piece_bpe_32k.model").collect()
    assert [(r.doc_id, r.decoded) for r in got] == rows and got[2].piece_ids is None and got[3].piece_ids == []
    assert piece_codec.with_pieces(frame(spark, []), f"{TOKENIZERS}/piece_bpe_32k.model").count() == 0


def test_gradients_of_the_network_equal_differences():
    rnd = np.random.default_rng(0)
    x, valid = language_id.lanes([b"hello wor", b"ab", b"xyz123"])
    inputs, recurrent = rnd.normal(size=(256, 9)).astype(np.float64), rnd.normal(size=(3, 9)).astype(np.float64)
    target = rnd.normal(size=(*x.shape, 3))
    loss = lambda i, r: float((language_id.read(x, valid, i, r).astype(np.float64) * target).sum())
    kept: list = []
    language_id.read(x, valid, inputs, recurrent, kept)
    d_inputs, d_recurrent = language_id.unread(x, valid, recurrent, kept, target)
    for grad, which in ((d_inputs, 0), (d_recurrent, 1)):
        for i, j in [(ord("l"), 1), (ord("o"), 4), (ord("a"), 7)] if which == 0 else [(0, 0), (1, 4), (2, 8)]:
            pair = [inputs.copy(), recurrent.copy()]
            pair[which][i, j] += 1e-3
            up = loss(*pair)
            pair[which][i, j] -= 2e-3
            assert abs((up - loss(*pair)) / 2e-3 - grad[i, j]) < 2e-2


def test_languages_of_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "12 34 %%", "en"), (-4, "the and of " * 30_000, None)], docs.schema)
    got = language_id.identify(docs.unionByName(odd).withColumns({"score": F.lit("mine")})).collect()
    assert len(got) == docs.count() + 4
    rows = {r.doc_id: r for r in got}
    assert [(rows[-i].lang_pred, rows[-i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3 and rows[-4].lang_pred == "en"
    held = [r for r in got if r.held_out and r.doc_id >= 0 and len(r.text.split()) > 20]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)


def test_languages_without_labels_or_rows(spark):
    rows = [(1, "hello there", None), (2, None, None)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert language_id.identify(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


ARTICLE = "<article><h1>Tit&eacute;l</h1><p>One  two\n<b>three</b>.<p>Four<br>five <a href='x'>six</a></p></article>"


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<p", ""), ("no markup at all but the words of a page that is as long as it has to be for this and that and the other, and it goes on with a lot "
     "of the words that are in all the texts of this kind, so that it is long enough to be good by itself", None),
    (f"<html><body><nav><ul><li><a href='/a'>a</a></ul></nav><div class='ad'>The buy of it</div>{ARTICLE}<footer>&copy; x</footer>", "Titél\n\nOne two three.\n\nFour five six"),
    (f"<header>site</header><aside>side</aside><main>{ARTICLE}<section id='comments'><p>nice</p></section><form><p>mail</form></main>",
     "Titél\n\nOne two three.\n\nFour five six"),
    ("<article><p>a &lt;b&gt; &amp;amp; c</p><script>var t='</p>';</script><style>p{}</style><p title='x>y'>d</p><!-- <p>no</p> --></article>", "a <b> &amp; c\n\nd"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 2999, "deep"), ("<article><p>same</p><p>same</p></article>", "same\n\nsame"),
    ("<article><p>x < y and z</p></article>", "x < y and z"),
])
def test_page_text(html, text):
    got = page_text.main_text(html)
    assert got == (text if text is not None else " ".join(html.split()))


LINKED = "<p>Before it.</p><ul><li><a href='x'>the first of the sources</a><li><a href='y'>the second</a></ul><p>After it.</p>"
POLISH = "Rankiem nad rzeką zebrało się wielu mieszkańców miasteczka, ponieważ wieczorem woda gwałtownie wezbrała przez burze oraz ulewy. " * 2


@pytest.mark.parametrize(("html", "text"), [
    ("<html class='no-sidebar'><body class='has-sidebar menu-open'><main id='search'><article class='post comments-open'><p>All of it.</p></article></main>", "All of it."),
    ("<body><div class='with-sidebar cookie-notice-closed'><article><p>All of it.</p></article></div>", "All of it."),
    ("<div class='widget'><div id='side'><article><p>All of it.</p><div class='comments'>nice</div></article></div>more</div>", "All of it."),
    ("<article><p>Post.</p></article><div class='comments-list'><article><p>nice</p></article></div>", "Post."),
    ("<article><p>Post.</p><div class='post-sidebar'>side</div><div class='ad'>buy</div><div class='ad-slot'>buy</div><div hidden>no</div></article>", "Post."),
    ("<article><p>Post.</p><div class='menu menu-open'>menu</div><div class='advertisement'>buy</div></article>", "Post."),
    ("<div hidden><article><p>gone</p></article></div>", ""),
    (f"<nav><a href='a'>nav</a></nav><article>{LINKED}</article>", "Before it.\n\nthe first of the sources\n\nthe second\n\nAfter it."),
    (f"<nav><a href='a'>home page</a></nav><div><p>{POLISH}</p></div>", POLISH.strip()),
])
def test_names_links_and_languages_drop_nothing_of_an_article(html, text):
    assert page_text.main_text(html) == text


LONG_PROSE = "The people of the town have been in this place for a long time and it is not known to them that there was a house on the hill, but they will be there. " * 2


@pytest.mark.parametrize("html, lost", [(f"<article><p>{a}</p>{{}}<p>{b}</p></article>", "") for a, b in (("Before.", "After."), (LONG_PROSE, LONG_PROSE))])
@pytest.mark.parametrize("inner, text", [
    *[(f"<div class='{name}'><p>{text}</p></div>", text) for text in ("It is short.", LONG_PROSE.strip()) for name in ("related-work", "side-effects", "share-price", "menu-items", "social-history")],
    ("<section id='search-methods'><p>We searched for it.</p></section>", "We searched for it."),
    ("<p>So <math><mi>x</mi> = 2</math> holds.</p>", "So x = 2 holds."), ("<p>Press <button>Start</button> to begin.</p>", "Press Start to begin."),
    ("<object data='x.pdf'><p>The file as a text.</p></object>", "The file as a text."), ("<p aria-hidden='true'>Seen by all but readers.</p>", "Seen by all but readers."),
])
def test_nothing_of_an_article_is_lost(html, lost, inner, text):
    got = page_text.main_text(html.format(inner)).split("\n\n")
    assert got[1:-1] == [text] and len(got) == 3


def test_links_confirm_a_doubt_and_buttons_alone_go():
    links = "<ul class='related-posts-of-ours'>" + "<li><a href='x'>some link text here</a>" * 5 + "</ul>"
    assert page_text.main_text(f"<article><p>{LONG_PROSE}</p>{links}<p><button>Share</button> <button>Like</button></p><p>End.</p></article>") == f"{LONG_PROSE.strip()}\n\nEnd."
    prose = f"<div><p>{LONG_PROSE}</p></div>"
    assert page_text.main_text(f"<nav><a href='x'>x</a></nav><article><p>{LONG_PROSE}</p></article>{prose}<footer>f</footer>") == LONG_PROSE.strip()
    between = page_text.main_text(f"<article><p>{LONG_PROSE}</p></article>{prose}<article><p>{LONG_PROSE}</p></article>")
    assert between.split("\n\n") == [LONG_PROSE.strip()] * 3


def brute_second_pass(page, labels):
    """The rules of the second pass, block by block, looking for neighbours step by step."""
    out = []
    for i, block in enumerate(page):
        def neighbour(step):
            j = i + step
            while 0 <= j < len(page):
                if labels[j] in ("good", "bad") and (page[j].main or not block.main):
                    return j
                j += step
            return None

        low, high = neighbour(-1), neighbour(1)
        sides = [j for j in (low, high) if j is not None]
        same = [labels[j] for j in sides if page[j].section == block.section]
        if labels[i] in ("good", "bad"):
            out.append(labels[i] == "good")
        elif block.main and not block.doubted:
            out.append(True)
        elif labels[i] == "outside":
            out.append([labels[j] for j in sides] == ["good", "good"])
        elif not sides:
            out.append(labels[i] == "near")
        elif len({labels[j] for j in sides}) == 1:
            out.append(labels[sides[0]] == "good")
        elif len(same) == 1:
            out.append(same[0] == "good")
        else:
            out.append(labels[i] == "near" or block.heading and labels[high] == "good")
    return out


def test_second_pass_equals_looking_for_neighbours():
    rnd = random.Random(21)
    for _ in range(400):
        page = [page_text.Block("x", 0, rnd.random() < 0.4, False, False, rnd.random() < 0.4, 0, rnd.random() < 0.2, rnd.randrange(4)) for _ in range(rnd.randint(0, 9))]
        labels = [rnd.choice(["good", "bad", "near", "short", "outside"]) for _ in page]
        assert page_text.second_pass(page, labels) == brute_second_pass(page, labels)


def test_pages_without_article_tags_give_the_same_text(sf_dir):
    import duckdb

    pages = duckdb.sql(f"SELECT html FROM '{sf_dir}/pages.parquet' WHERE html IS NOT NULL").fetchall()
    texts = [(page_text.main_text(h), page_text.main_text(re.sub(r"<(/?)article", r"<\1div", h))) for (h,) in pages]
    assert all(set(bare.split("\n\n")) <= {*whole.split("\n\n"), ""} for whole, bare in texts)
    assert sum(whole == bare for whole, bare in texts) >= 0.8 * len(texts)


def test_undecided_blocks_take_after_their_neighbours():
    good = "The people of the town have been in this place for a long time and it is not known to them that there was a house on the hill, but they will "
    long = f"<p>{good * 3}</p>"
    assert "A short line" in page_text.main_text(f"{long}<p>A short line</p>{long}")
    links = "<ul>" + "<li><a href='x'>some link text here</a>" * 5 + "</ul>"
    assert "A short line" not in page_text.main_text(f"{links}<div><p>A short line</p></div>{links}<div>{long}</div>")


def test_pages_of_a_table(spark):
    rows = [(1, "u", None), (1, "u", None), (2, None, ARTICLE), (None, "v", "<article>é😀</article>")]
    got = page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine"))).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == [
        (1, "u", "", 0), (1, "u", "", 0), (2, None, "Titél\n\nOne two three.\n\nFour five six", 36), (None, "v", "é😀", 2)]
    assert page_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_words_equal_the_library_and_stay_quick(codec):
    import time

    own, library = codec
    rnd = random.Random(12)
    words = {n: "".join(rnd.choice(letters) for _ in range(size)) for n, (letters, size) in enumerate([
        ("abcdefghijklmnopqrstuvwxyz", 1_000_000), ("ABCabcXYZ0123456789+/", 40_000), ("的一是不了人我在有他这中", 30_000), ("a", 30_000), ("ab", 20_000), ("-", 20_000), (" ", 9_000)])}
    words |= {20: "ab" * 9_000, 21: "=" * 5_000 + "x" * 5_000, 22: "\u0e01\U0001f600" * 3_000}
    begin = time.monotonic()
    found = {n: own.encode([w])[0].tolist() for n, w in words.items()}
    assert time.monotonic() - begin < 60
    assert all(found[n] == library.encode(w) for n, w in words.items())


def test_ids_do_not_depend_on_what_is_kept(codec, monkeypatch):
    own, library = codec
    rnd = random.Random(13)
    texts = [" ".join("".join(rnd.choice("abcdeé,.") for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(0, 40))) for _ in range(120)]
    monkeypatch.setattr(piece_codec, "KNOWN_STRETCHES", 50)
    for low in range(0, 120, 7):
        assert [x.tolist() for x in own.encode(texts[low : low + 7])] == library.encode(texts[low : low + 7])


def test_runs_of_digits_take_linear_time_and_keep_their_spans():
    import time

    text = "1" * 1_000_000 + " 10.0.0.1 " + "9" * 300_000 + ".1.2 " + "7.7.7." * 50_000
    begin = time.monotonic()
    found = personal_data.base_spans(text)
    assert time.monotonic() - begin < 5 and (1, 1_000_001, 1_000_009) in found
    slow = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rnd = random.Random(5)
    for _ in range(300):
        text = "".join(rnd.choice("0123.. 5a") for _ in range(rnd.randint(0, 60)))
        want = [(1, *m.span()) for m in slow.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [x for x in personal_data.base_spans(text) if x[0] == 1] == want


def test_the_field_does_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(personal_data, "SAMPLE_DOCS", 40)
    rnd = random.Random(6)
    rows = [(i if i % 9 else None, f"call +1 {rnd.randrange(10**9, 10**10)} or mail a{i}@b{i % 5}.org, {rnd.randrange(10**6)} more") for i in range(400)]
    models = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows[:: 1 if parts == 1 else -1], "doc_id long, text string").repartition(parts)
        models.append(personal_data.fitted(df, "doc_id", "text"))
    assert all(np.allclose(models[0][k], models[1][k]) for k in models[0])
    texts = [t for _, t in rows]
    base = [personal_data.base_spans(t) for t in texts]
    whole = personal_data.added_spans(texts, base, models[0])
    monkeypatch.setattr(personal_data, "MARKS", 30)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array(texts)], ["id", "text"])
    parts = list(personal_data.sliced([batch]))
    assert len(parts) > 50 and [t for p in parts for t in p.column(1).to_pylist()] == texts
    cut = [x for p in parts for x in personal_data.added_spans(p.column(1).to_pylist(), [personal_data.base_spans(t) for t in p.column(1).to_pylist()], models[0])]
    assert cut == whole


def test_long_starts_of_tokens_take_linear_time():
    import time

    begin = time.monotonic()
    found = secret_ledger.findings("eyJ" * 200_000 + " eyJabcdefgh.abcdefgh1.abcdefgh2 ", secret_ledger.rules())
    assert time.monotonic() - begin < 3 and [f[0] for f in found] == ["jwt"]
