"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import struct
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scarmap.llm import chat, html, html_pages, langid, licenses, line_dedup, mixing, order_minhash, simhash, topk
from scarmap.llm.license_texts import TEMPLATES, license_table

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, component_id string, key string"


def words(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def documents(spark, n=60, seed=1):
    rng = random.Random(seed)
    base = [words(rng, 80) for _ in range(n)]
    rows = [(i, t, None, f"s{i % 4}") for i, t in enumerate(base)]
    rows += [(200 + i, base[i].replace("alpha", "Alpha"), None, "s1") for i in range(10)]  # copies but for case
    rows += [(300 + i, base[i] + " tail", None, None) for i in range(10)]
    rows += [(400, None, "en", "s1"), (401, "", "en", None), (402, " \n\t ", None, "s2"), (403, "one two", None, "s2"), (404, "One  TWO", None, "s2"), (None, base[3], None, "s3"), (5, base[5], None, "s1"), (405, "long words here " * 20000, None, "s0")]
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA), rows


def brute_fingerprint(text, k=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", w) if x]
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("bucket", [128, 1])
def test_simhash_components_against_all_pairs(spark, bucket):
    df, rows = documents(spark)
    got = simhash.simhash_components(df, pair_bucket=bucket).collect()
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    want = sorted((d if d is not None else -1, f, min(r[0] for r, c in zip(rows, comp, strict=True) if c == comp[i] and r[0] is not None)) for i, ((d, *_), f) in enumerate(zip(rows, fps, strict=True)))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fp % (1 << 64), r.component_id) for r in got) == want
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_covering_masks_leave_no_pair_out():
    masks, rng = [m % (1 << 64) for m in simhash.covering_masks(3)], random.Random(2)
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(not flips & m for m in masks)


def test_html_labels_and_odd_pages(spark):
    model = html.trained()
    wrong = total = 0
    for seed in range(9000, 9060):
        page, want = html_pages.labelled_page(seed)
        found = html.blocks(page)
        x, mask = html._padded([html.features(found)])
        wrong += int(((model.scores(x, mask)[0] > 0) != np.array(want)).sum())
        total += len(want)
    assert wrong / total < 0.02
    page = '<html><head><title>T</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>A &amp; B</h1><p><b>One\n two &eacute;.<br><p>Three four five six.</p></article><footer>&copy; x</footer><a hre'
    rows = [(1, "u", page, "c"), (2, None, None, "c"), (3, "u", "", "c"), (None, "u", "<!-- x", "c"), (5, "u", "<script>var a='</p>'</script>", "c")]
    got = {r.page_id: (r.text, r.n_chars) for r in html.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    text = "A & B\nOne two é.\nThree four five six."
    assert got == {1: (text, len(text)), 2: ("", 0), 3: ("", 0), None: ("", 0), 5: ("", 0)}


def slow_scores(model, x):
    """The labeller, one number after the other."""
    h = html.HIDDEN
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    p = {k: v.astype(float) for k, v in model.p.items()}
    states = {}
    for d in "fb":
        state, cell = [0.0] * h, [0.0] * h
        for k in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            on = np.flatnonzero(x[k])
            z = [sum(x[k][i] * p[f"x{d}"][i][j] for i in on) + sum(state[i] * p[f"h{d}"][i][j] for i in range(h)) + p[f"b{d}"][j] for j in range(4 * h)]
            cell = [sigmoid(z[h + j]) * cell[j] + sigmoid(z[j]) * np.tanh(z[3 * h + j]) for j in range(h)]
            state = [sigmoid(z[2 * h + j]) * np.tanh(cell[j]) for j in range(h)]
            states[d, k] = state
    return [sum(s * o for s, o in zip(states["f", k] + states["b", k], p["out"], strict=True)) + p["bias"][0] for k in range(len(x))]


def test_html_labeller_against_plain_sums():
    model = html.trained()
    pages = [html.blocks(html_pages.labelled_page(seed)[0]) for seed in (9100, 9101)]
    x, mask = html._padded([html.features(b) for b in pages])
    scores = model.scores(x, mask)
    for row, found in enumerate(pages):
        want = slow_scores(model, html.features(found).astype(float))
        assert np.allclose(scores[row][: len(found)], want, atol=1e-3)
        for at_once in (1, 3, 1000):
            assert np.allclose(model.long_scores(found, at_once), want, atol=1e-3)
    page = html_pages.labelled_page(9102)[0]
    assert html.extract([page], model, at_once=2) == html.extract([page], model)


def test_html_open_deep_and_long_pages():
    texts = lambda page: [b.text for b in html.blocks(page)]
    for tag in ("noscript", "template", "svg", "iframe", "object"):
        assert texts(f"<p>One.</p><{tag}>n<p>Rest of article.</p>") == ["One.", "n", "Rest of article."]
        assert texts(f"<p>One <{tag} a='>'>n<p>m</p></{tag.upper()} >two.</p><p>Rest.") == ["One two.", "Rest."]
        assert texts(f"<{tag}>a</{tag}><{tag}>b<p>c</p>") == ["b", "c"]
    assert texts("<p>a<svg/>b</p><svg><title>t</title></svg>c") == ["ab", "c"]
    assert texts("<p>a</p><script>x<p>y") == ["a"]
    began = time.time()
    deep = html.blocks("<div class='x'>" * 40_000 + "in" + "</div>" * 20_000 + "out" + "</section>" * 20_000)
    assert [b.text for b in deep] == ["in", "out"]
    assert len(html.blocks("<object>" * 20_000 + "x")) == 1
    assert len(html.blocks("<ul>" + "<li>a<div>" * 20_000)) == 20_000
    assert time.time() - began < 20
    model = html.trained()
    page = "<html><body><article>" + "<p>Some words stand here, in a row.</p>" * 30_000 + "</article></body></html>"
    assert html.extract([page], model)[0].count("\n") == 29_999


def test_chat_round_trip_and_loss(spark):
    nasty = ["\\### Assistant: </turn> ok", "<:user>x</>", "<+>", "\\s\\l\\g\\", "", None, "é\n🙂", "a" * 50000]
    turns = [(1, i, ["user", "assistant", "assistant"][i % 3], t, "x") for i, t in enumerate(nasty)]
    turns += [(2, None, "assistant", "first", "x"), (2, 0, None, "b", "x"), (2, 0, None, "b", "x"), (None, 1, "a>b", "c", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, segments string")
    out = chat.format_chats(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("segments"))).collect()
    for r in out:
        own = sorted(((t, ro or "", x or "") for c, t, ro, x, _ in turns if c == r.conv_id), key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))
        assert [(t.role, t.text) for t in r.turns] == [(ro, x) for _, ro, x in own]
        assert r.loss == "".join(x for _, ro, x in own if ro == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
    assert len(out) == 3 and chat.format_chats(df.limit(0)).count() == 0
    assert next(r for r in out if r.conv_id == 1).formatted.count("<:assistant>") == 3  # neighbours are merged


def test_order_minhash_edits(spark):
    df, rows = documents(spark)
    got = order_minhash.edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    order = sorted({(d, t or "") for d, t, *_ in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    follow = {order[i]: order[(i + 1) % len(order)] for i in range(len(order))}
    for r in got:
        t = next(x for d, x in order if d == r.doc_id)
        q = len(t) // 4
        edited = t[: len(t) - q] + follow[r.doc_id, t][1][:q]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by = {}
    for r in got:
        by.setdefault(next((x for d, x in order if d == r.doc_id)), set()).add(tuple(r.signature))
    assert all(len(s) == 1 for s in by.values())
    long = [r for r in got if r.doc_id is not None and r.doc_id < 55]
    assert sum(r.near_edited > r.near_next for r in long) >= 0.95 * len(long)


def signed(x):
    x %= 1 << 64
    return x - (1 << 64) if x >> 63 else x


def spark_hash(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v, h)
    return signed(h)


def brute_signature(text):
    """The signature step by step, with plain lists."""
    w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", text or "") if x]
    if not w:
        return []
    as_long = lambda x: struct.pack("<q", x)
    letters = [as_long(spark_hash(p)) for x in w for p in ([list(x[i : i + 12]) for i in range(len(x) - 11)] if len(x) > 12 else [[x]])]
    grams = [(spark_hash(letters[i : i + 2]) << 28, i) for i in range(len(letters) - 1)] or [(struct.unpack("<q", letters[0])[0] << 28, 0)]
    seen, numbered = {}, []
    for h, i in sorted(((signed(h) >> 28, i) for h, i in grams)):
        seen[h] = seen.get(h, -1) + 1
        numbered.append((i, spark_hash([as_long(h), struct.pack("<i", seen[h])]) % (1 << 64) >> 28))
    out = []
    for j in range(32):
        ordered = [(spark_hash([as_long(x), struct.pack("<i", j)]), i) for i, x in numbered]
        chosen = sorted(sorted(ordered)[:2], key=lambda x: x[1])
        out.append(spark_hash([as_long(x) for x, _ in chosen]))
    return out


def test_order_minhash_against_plain_lists(spark):
    rng = random.Random(14)
    texts = [words(rng, n) for n in (8, 9, 30, 400)] + ["x " * 50, "one two", "a", "é" * 40, "".join(rng.choice("abcdefgh") for _ in range(500)), "", None, " \n", "的一是在不了有和人这中大为上个国我以要他" * 3]
    texts += [texts[8][:250] + "ZZ" + texts[8][250:], " ".join(texts[3].split()[5:])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r.s for r in order_minhash.with_signature(df, "t", "s").collect()}
    assert all(got[i] == brute_signature(t) for i, t in enumerate(texts))
    pairs = [(8, 13), (3, 14), (3, 2), (9, 10), (9, 3), (5, 6), (7, 7)]
    sigs = spark.createDataFrame([(got[a], got[b]) for a, b in pairs], "a array<long>, b array<long>")
    like = [r[0] for r in sigs.select(order_minhash.likeness(F.col("a"), F.col("b"))).collect()]
    plain = lambda a, b: 1.0 if not a and not b else 0.0 if not a or not b else sum(x == y for x, y in zip(a, b, strict=True)) / 32
    assert like == [plain(got[a], got[b]) for a, b in pairs]
    assert like[0] > 0.5 and like[1] > 0.8 and like[2] < 0.2 and like[3] == 1 and like[4] == 0 and like[6] == 1


def test_order_minhash_of_edits_on_both_sides_of_word_limits(spark):
    """Texts of six to nine words, words of 11 to 14 and 23 to 26 characters: an edited text stays alike."""
    rng = random.Random(23)
    few = [words(rng, n) for n in (6, 7, 8, 9) for _ in range(6)]
    long = [" ".join("".join(rng.choice("abcdefgh") for _ in range(n)) for _ in range(10)) for n in (11, 12, 13, 14, 23, 24, 25, 26)]
    long += ["".join(rng.choice("的一是在不了有和人这中大") for _ in range(n)) for n in (40, 200)]
    # as the query edits: the last quarter is the beginning of another text of its sort
    rows = [(t, t[: len(t) - len(t) // 4] + after[: len(t) // 4]) for of in (few, long[:8], long[8:]) for t, after in zip(of, of[1:] + of[:1], strict=True)]
    # a word that crosses the limit changes its own letters only
    rows += [(t, t[:100] + "yy" + t[100:]) for t in long[:8]]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in order_minhash.with_signature(order_minhash.with_signature(df, "a", "sa"), "b", "sb").select(order_minhash.likeness(F.col("sa"), F.col("sb"))).collect()]
    assert min(got) > 0, got


def test_order_minhash_sees_order_and_repeats(spark):
    rng = random.Random(4)
    a = words(rng, 400).split()
    swapped = a[200:] + a[:200]
    shuffled = rng.sample(a, len(a))
    df = spark.createDataFrame([(" ".join(a), " ".join(x)) for x in (a, swapped, shuffled, a + a)], "a string, b string")
    got = order_minhash.with_signature(order_minhash.with_signature(df, "a", "sa"), "b", "sb").select(order_minhash.likeness(F.col("sa"), F.col("sb"))).collect()
    assert got[0][0] == 1 and got[1][0] < 0.8 and got[2][0] < 0.2 and got[3][0] < 0.9


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(6)
    v = [(i, [float(x) for x in rng.normal(0, 0.2, 16)], i % 3) for i in range(300)]
    v += [(300, v[7][1], 0), (301, v[7][1], 0), (302, None, 0), (303, [None] + [0.1] * 15, 0), (304, [float("nan")] + [0.1] * 15, 0), (305, [float("inf")] * 16, 0), (306, [0.0] * 16, 0), (None, [0.1] * 16, 0)]
    df = topk.scaled(spark.createDataFrame(v, "vec_id long, embedding array<float>, score int"))
    got = topk.top_k(df.where("id % 5 = 0"), df, candidate_block=64, query_block=16)
    x = {i: np.floor(256 * np.array(e, np.float32).astype(float)).astype(int) for i, e, _ in v if i is not None and e is not None and all(c is not None and np.isfinite(c) for c in e)}
    want = []
    for q in x:
        if q % 5 == 0:
            best = sorted(((-int(x[q] @ x[c]), c) for c in x if c != q))[:5]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == sorted(want)
    few = df.where("id < 3")
    assert topk.top_k(few, few).groupBy("query_id").count().select(F.max("count")).first()[0] == 2
    assert topk.top_k(few.limit(0), few.limit(0)).count() == 0


def test_top_k_of_big_numbers():
    """Bounds in doubles that round, scores beyond 64 bits."""
    rng = np.random.default_rng(5)
    x = rng.integers(-(1 << 40), 1 << 40, (90, 6)) // rng.integers(1, 1 << 20, (90, 6))
    x[80:] = x[70:80] + rng.integers(-1, 2, (10, 6))  # scores that doubles can't tell apart
    q = np.concatenate([x[70:75], [[1 << 61, 1, 0, 0, 0, -(1 << 61)]]])
    cols, rows, scores = topk.Lists(np.arange(90), x).best(np.arange(200, 206), q, 4, few=3)
    for c in range(6):
        exact = sorted((-sum(int(a) * int(b) for a, b in zip(q[c], x[i], strict=True)), i) for i in range(90))[:4]
        assert rows[cols == c].tolist() == [i for _, i in exact]
        assert scores[cols == c].tolist() == [max(min(-s, (1 << 63) - 1), -(1 << 63)) for s, _ in exact]


def test_top_k_of_unequal_lengths_and_huge_components(spark):
    v = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0]), (4, []), (5, [1e300, 1.0]), (6, [3.0, 0.0, 1.0]), (6, [3.0, 0.0, 1.0]), (7, [2.5])]
    df = topk.scaled(spark.createDataFrame(v, "vec_id long, embedding array<double>"))
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, df).collect()}
    assert got == {(1, 1, 2, 4 * 65536), (2, 1, 1, 4 * 65536), (3, 1, 7, 640 * 256), (7, 1, 3, 640 * 256)}


def test_mixing_budgets(spark):
    df, rows = documents(spark)
    got = mixing.mix_words(df).collect()
    size = lambda t: len([w for w in __import__("re").split("[\x20\x09-\x0d]+", t or "") if w])
    total = {}
    for _, t, _, s in rows:
        total[s] = total.get(s, 0) + size(t)
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight, capped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, set()
    while True:  # reshare until none is above
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)
        target = {s: 2 * total[s] if s in capped else left * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names}
        over = {s for s in names if target[s] > 2 * total[s] + 1e-9}
        if not over:
            break
        capped |= over
    by_size = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        by_size.setdefault(r.source_size, []).append(r)
    assert sorted(r["size"] for r in got) == sorted(size(t) for _, t, *_ in rows)
    for s in names:
        assert sum(r.taken for r in by_size[total[s]]) == round(target[s]) and by_size[total[s]][0].target == pytest.approx(target[s])
    assert sorted(map(str, mixing.mix_words(df).collect())) == sorted(map(str, got))
    assert mixing.mix_words(df.limit(0)).count() == 0
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns and mixing.mix_documents(df.limit(0)).count() == 0
    # by hand: whole epochs, then rows in the order of the key while half of them is within the rest
    keys = {(r.doc_id, r.text): r.k for r in df.select("doc_id", "text", mixing.order_key(df).alias("k")).collect()}
    want = {}
    for s in names:
        epochs, rest = divmod(round(target[s]), total[s]) if total[s] else (0, 0)
        own = sorted((keys[d, t], (d is not None, d), size(t), d, t) for d, t, _, x in rows if x == s)
        before, cut = 0, None
        for k, _, n, d, t in own:
            if before + n / 2 <= rest and rest > 0:
                cut = k
            before += n
        for k, _, n, d, t in own:
            want[d, t, s] = want.get((d, t, s), 0) + epochs + (cut is not None and k <= cut)
    got = {}
    for r in mixed.collect():
        got[r.doc_id, r.text, r.source] = got.get((r.doc_id, r.text, r.source), 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    for s in names:
        taken = sum(size(t) * n for (d, t, x), n in got.items() if x == s)
        assert abs(taken - target[s]) <= max([size(t) for _, t, _, x in rows if x == s], default=0)


def jaccard(a, b, k=10):
    x, y = ({t[i : i + k] for i in range(max(1, len(t) - k + 1))} for t in (a, b))
    return len(x & y) / len(x | y)


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(8)
    lines = [words(rng, 12) for _ in range(40)]
    near = [x[:-1] + "z" for x in lines[:10]] + [x.upper() for x in lines[10:15]]
    docs = [(i, "\n".join(rng.sample(lines + near, 4) + ["short"]), "x") for i in range(50)] + [(60, None, "x"), (61, "", "x"), (None, lines[0], "x"), (3, None, "y")]
    docs += [(0, docs[0][1], "twin")]
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string, n_lines string")).collect()
    places = sorted({(-1 if d is None else d, xxhash.xxh64_intdigest((t or "").encode(), 42), p, line_dedup.normalised(x)) for d, t, _ in docs if t is not None for p, x in enumerate(t.split("\n")) if len(line_dedup.normalised(x)) >= 40})
    texts = sorted({p[3] for p in places})
    comp = {t: t for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if jaccard(a, b) >= 0.8 and comp[a] != comp[b]:
                old, new = comp[a], comp[b]
                comp = {k: new if c == old else c for k, c in comp.items()}
    dropped = len(places) - len({comp[p[3]] for p in places})
    seen, got = set(), 0
    for r in out:
        if (r.doc_id, r.text) not in seen:
            got += r.n_dropped
        seen.add((r.doc_id, r.text))
        assert r.n_lines == (0 if r.text is None else r.n_dropped + (0 if r.n_lines == r.n_dropped else len(r.text.split("\n"))))
    assert got == dropped and len(out) == len(docs)
    twins = [r.text for r in out if r.doc_id == 0]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert all("short" in r.text for r in out if r.text is not None and r.doc_id is not None and r.doc_id < 50)
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_bands_do_not_depend_on_company():
    rng = random.Random(9)
    lines = [words(rng, 10) for _ in range(30)]
    alone = np.concatenate([line_dedup.band_keys([x]) for x in lines])
    assert (line_dedup.band_keys(lines) == alone).all()


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.97
    rows = [(1, None, "en"), (2, "123 !?", "en"), (3, "", None), (None, "the cat", None), (4, "the cat and the dog", "en"), (6, "der hund und die katze", "de"), (7, "the the", None)]
    out = {r.doc_id: r for r in langid.language_id(spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, lang string, score double")).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and out[1].score == 0.0
    assert all(0 <= r.score <= 1 for r in out.values())
    assert langid.language_id(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_language_id_against_plain_vectors(spark):
    """Profiles and cosines worked out letter by letter."""
    texts = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("a dog, and 3 cats!", "en"), ("der hund und die katze", "de"), ("die Katze; der Hund", "de"), ("le chat et le chien", "fr"), ("\u0436\u0443\u043a", None), ("z", "en")] * 3)]
    held = lambda i: __import__("zlib").crc32(str(i).encode()) % 5 == 0
    of, n = langid._symbols()
    v = langid._letter_vectors()

    def vector(text):
        out, gap = np.zeros(langid.DIMS), [0]
        for c in text.lower():
            if of[ord(c)] or gap[-1]:
                gap.append(int(of[ord(c)]))
        gap += [0] if gap[-1] else []
        for a, b, c in zip(gap, gap[1:], gap[2:], strict=False):
            if a or b or c:
                out += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c] if (b or c) else 0
        return out

    sums = {}
    for i, t, lang in texts:
        if lang and not held(i):
            sums[lang] = sums.get(lang, 0) + vector(t)
    got = {r.doc_id: r for r in langid.language_id(spark.createDataFrame(texts, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in texts:
        x = vector(t)
        cos = {k: float(x @ s / np.linalg.norm(x) / np.linalg.norm(s)) for k, s in sums.items()}
        best = max(sorted(cos), key=cos.get)
        assert got[i].held_out == held(i) and got[i].score == pytest.approx(max(0.0, cos[best]), abs=1e-4)
        assert got[i].lang_pred == best or abs(cos[got[i].lang_pred] - cos[best]) < 1e-4


def test_bundled_vectors_agree():
    grams, counts = langid.trigrams("The quick brown fox, the lazy dog; über Straße" * 3)
    assert np.allclose(langid.Bound(kept=1 << 10).bundle(grams, counts), langid.bundle(grams, counts))


def brute_windows(text, template):
    w, t = (__import__("re").sub(r"[\W_]+", " ", x.lower()).split() for x in (text or "", template))
    grams = lambda x: [tuple(x[i : i + 5]) for i in range(len(x) - 4)] or ([tuple(x)] if x else [])
    size = max(8, 1 << (len(t) - 1).bit_length())
    g, own = grams(w), set(grams(t))
    n = size + size // 2 - 4
    return max([len(own & set(g[s : s + n])) / len(own) for s in range(0, max(1, len(g)), size // 2)], default=0.0)


def test_license_scan_against_every_window(spark):
    rng = random.Random(10)
    texts = [words(rng, rng.randrange(60)) + "\n" + TEMPLATES[k].replace(" ", "\n ", rng.randrange(3)) + " " + words(rng, rng.randrange(60)) for k in TEMPLATES for _ in range(3)]
    cut = [" ".join(TEMPLATES["mit"].split()[: n]) for n in (20, 60, 75)]
    texts += cut + [None, "", "the mit license", words(rng, 300)] + [TEMPLATES["bsd"].upper() + words(rng, 5000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, TEMPLATES["isc"], "x"), (0, texts[0], "x")], "doc_id long, text string, containment string")
    table = license_table(spark)
    got = {(r.doc_id, r.license_id): r.containment for r in licenses.scan_licenses(df, table).collect()}
    want = {(i, k): c for i, t in [*enumerate(texts), (None, TEMPLATES["isc"])] for k in TEMPLATES if (c := brute_windows(t, TEMPLATES[k])) >= 0.8}
    assert got == pytest.approx(want)
    assert licenses.scan_licenses(df.limit(0), table).count() == 0 and licenses.scan_licenses(df, table.limit(0)).count() == 0


def test_license_templates_are_a_table_of_bounded_size(spark, monkeypatch):
    rng = random.Random(3)
    own = words(rng, 200)
    table = spark.createDataFrame([("own", own), ("own", own), ("other", words(rng, 30)), ("none", " "), ("null", None)], "license_id string, text string")
    texts = [(1, words(rng, 50) + " " + own), (1, own), (2, " ".join(own.split()[:150])), (3, words(rng, 400))]
    got = sorted((r.doc_id, r.license_id) for r in licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), table).collect())
    assert got == [(1, "own")]
    monkeypatch.setattr(licenses, "MOST_TEMPLATE_WORDS", 100)
    with pytest.raises(ValueError):
        licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), table)
