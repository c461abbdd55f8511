"""Foreign columns of every name, whole url scores against plain code, labels that are mostly copies."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from offerlake.llm import bpe_trie, common, embed_dedup, exact_topk, lang_id, packing, url_filter
from offerlake.llm.queries import vocabulary

WORDS = vocabulary("word_bpe_49k.json")
BYTES = vocabulary("byte_bpe_50k.json")


def with_names(df, names):
    """``df`` with extra columns of these names, each holding its own name."""
    return df.withColumns({n: F.lit(n) for n in names if n not in df.columns})


def foreign(row, names, given):
    return all(row[n] == n for n in names if n not in given)


URL_NAMES = ["_in", "_url", "_text", "_row", "_given", "_g", *(f"_c{k}" for k in range(5)), *(f"_r{k}" for k in range(5)), "g", "a", "b", "v", "ctx", "s", "n", "at", "suffix", "host", "path", "rule", "verdict", "score", "a.b"]


def test_urls_keep_foreign_columns(spark):
    urls = ["http://a.org/x", "http://b.com/de/1", "http://c.net/q?x=1", None, "http://a.org/x"]
    df = with_names(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), URL_NAMES).repartition(2)
    rows = url_filter.judge(df).collect()
    assert sorted(r.page_id for r in rows) == list(range(5))
    given = ("host", "path", "rule", "verdict", "score")
    assert all(foreign(r, URL_NAMES, given) for r in rows) and {r.page_id: r.url for r in rows} == dict(enumerate(urls))
    assert all(r.verdict in ("allow", "block") for r in rows)


def test_url_scores_and_verdicts_equal_plain_code(spark):
    pages = spark.read.parquet(f"{SF_SMOKE}/pages.parquet").select("page_id", "url").unionByName(
        spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(["", "é://x", "http://x.net/?a=%20", None, "no scheme"])], "page_id long, url string"))
    rows = url_filter.judge(pages).collect()
    rest = {r["url"]: r["h"] for r in pages.select("url", url_filter.held_out(F.coalesce("url", F.lit(""))).alias("h")).collect()}
    symbols, m, size = url_filter.SYMBOLS, url_filter.M, len(url_filter.SYMBOLS)

    def chars(url):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
        return "".join(c if c in symbols[:-2] and c != "*" else "*" for c in low) + "$"

    fits = [(v, h, p) for v, h, p in url_filter.RULES]

    def given(r):
        best = [(len(h + p), v) for v, h, p in fits if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        return max(best)[1] if best else None

    decided = {r.page_id: given(r) for r in rows}
    counts = {k: [Counter(), Counter()] for k in range(5)}
    positions = 0
    for r in rows:
        if decided[r.page_id] and not rest[r.url]:
            t = "^" * 4 + chars(r.url)
            which = decided[r.page_id] == "block"
            positions += len(t) - 4
            for i in range(4, len(t)):
                for k in range(5):
                    counts[k][which][t[i - k:i], t[i]] += 1
    totals = {k: [Counter(), Counter()] for k in counts}
    for k in counts:
        for w in (0, 1):
            for (ctx, _), n in counts[k][w].items():
                totals[k][w][ctx] += n

    def p(w, ctx, c):
        q = p(w, ctx[1:], c) if ctx else 1 / size
        return (counts[len(ctx)][w][ctx, c] + m * q) / (totals[len(ctx)][w][ctx] + m)

    kept = lambda ctx: totals[len(ctx)][0][ctx] + totals[len(ctx)][1][ctx] >= positions / url_filter.SUPPORT

    def score(url):
        t = "^" * 4 + chars(url)
        out = []
        for i in range(4, len(t)):
            ctx = next(t[i - k:i] for k in range(4, -1, -1) if kept(t[i - k:i]))
            out.append(math.log(p(0, ctx, t[i])) - math.log(p(1, ctx, t[i])))
        return sum(out) / len(out)

    mine = {r.page_id: score(r.url) for r in rows}
    for r in rows:
        assert r.score == pytest.approx(mine[r.page_id], abs=1e-9)
    marked = [(math.floor(mine[r.page_id] * url_filter.STEPS), decided[r.page_id]) for r in rows if decided[r.page_id] and rest[r.url]]
    assert {v for _, v in marked} == {"allow", "block"}
    n_allow, n_block = (sum(v == k for _, v in marked) for k in ("allow", "block"))
    rate = {at: sum(v == "allow" for s, v in marked if s >= at) / n_allow + 1 - sum(v == "block" for s, v in marked if s >= at) / n_block for at, _ in marked}
    best = min(at for at in rate if rate[at] > max(rate.values()) - 1e-12) / url_filter.STEPS
    for r in rows:
        assert r.verdict == (decided[r.page_id] or ("allow" if r.score >= best else "block"))


PACK_NAMES = ["_in", "_text", "_size", "_group", "p", "pieces", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "_rows", "a.b"]


@pytest.mark.parametrize("ids", [False, True])
def test_packing_keeps_foreign_columns(spark, ids):
    rnd = random.Random(0)
    texts = [None, "", "one", "two words", "long " * 3000] + [" ".join(rnd.choices("abcdef", k=rnd.randint(0, 400))) for _ in range(60)]
    df = with_names(spark.createDataFrame([(None if i == 3 else 2**60 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"), PACK_NAMES).repartition(3)
    rows = packing.pack_documents(df, WORDS, ids=ids).collect()
    given = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset") + (("ids",) if ids else ())
    assert all(foreign(r, PACK_NAMES, given) for r in rows)
    pieces = Counter()
    for r in rows:
        pieces[r.doc_id] += r.length
    assert sum(pieces.values()) == sum({r.doc_id: r.doc_tokens for r in rows}.values()) and len(pieces) == len(texts) and 2**60 + 4 in pieces
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by_sequence.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
    assert packing.pack_documents(df.limit(0), WORDS).count() == 0


def test_decode_replaces_a_column_of_its_name(spark):
    df = with_names(spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string"), ["decoded", "ids", "part"])
    out = bpe_trie.decode(bpe_trie.encode(df.drop("ids"), BYTES), BYTES).orderBy("id").collect()
    assert [(r.decoded, r.part) for r in out] == [("a b", "part"), ("", "part")]


def test_labels_that_are_mostly_copies_are_learned(spark):
    rnd = random.Random(1)
    alphabets = ["".join(rnd.sample("abcdefghijklmnopqrstuvwxyz", 6)) for _ in range(13)]
    text = lambda a: " ".join("".join(rnd.choices(a, k=rnd.randint(3, 9))) for _ in range(40))
    rows = [(text(alphabets[0]), "l00") for _ in range(4000)]
    for k in range(1, 13):  # one text each, thousands of times
        rows += [(text(alphabets[k]), f"l{k:02d}")] * 3000
    rows += [(None, "l00"), ("", "l01"), ("x y", None)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    model = lang_id.fit(docs)
    assert model["langs"] == [f"l{k:02d}" for k in range(13)]
    some = spark.createDataFrame([(k, text(a)) for k, a in enumerate(alphabets)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in lang_id.predict(some, model).collect()}
    assert sum(got[k] == f"l{k:02d}" for k in got) >= 12


def test_label_and_score_equal_plain_code(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text", "lang")
    model = lang_id.fit(docs.where("doc_id % 5 <> 0"))
    held = docs.where("doc_id % 5 = 0").collect()
    langs = model["langs"]
    dense = np.tile(model["unseen"], (len(model["grams"]) + 1, 1))
    for g in range(len(model["grams"])):
        for e in range(model["ends"][g], model["ends"][g + 1]):
            dense[g, model["lang"][e]] += model["adds"][e]
    assert np.allclose(np.exp(dense[:-1]).sum(0) + np.exp(model["unseen"]), 1)

    def plain(text):
        words = (text or "").lower().split()
        scores, logs, letters = [], [], []
        for w in words:
            w = lang_id.letters_of(w)
            rows = [dense[model["grams"].get(g, -1)] for g in (lang_id.grams_of(w) if w else [])]
            open_to = np.ones(len(langs), bool)
            for s in {lang_id.script_of(c) for c in w}:
                open_to &= model["scripts"].get(s, np.zeros(len(langs), bool))
            total = np.sum(rows, 0) if rows else np.zeros(len(langs))
            seen = open_to.any() and bool(w)
            total = np.where(open_to, total, -np.inf) if seen else np.zeros(len(langs))
            logs.append(total)
            scores.append(np.maximum(total - total.max(), -lang_id.WORST))
            letters.append((len(w), seen))
        if not any(n for n, _ in letters):
            return "und", 0.0
        best, back = scores[0], []
        for s in scores[1:]:
            lead = int(best.argmax())
            stay = best >= best[lead] - lang_id.SWITCH
            back.append(np.where(stay, np.arange(len(langs)), lead))
            best = np.where(stay, best, best[lead] - lang_id.SWITCH) + s
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        path.reverse()
        share, logp = np.zeros(len(langs)), np.zeros(len(langs))
        for k, (n, seen), total, s in zip(path, letters, logs, scores, strict=True):
            if seen:
                share[k] += n
                logp[k] += total.max() + s[k]
        win = int(share.argmax())
        whole = share[win] / sum(n for n, _ in letters)
        return langs[win], float(whole * lang_id.fit_of(model["expected"], win, logp[win], share[win])) if share[win] else 0.0

    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in lang_id.predict(spark.createDataFrame(held, docs.schema).select("doc_id", "text"), model).collect()}
    for r in held:
        label, score = plain(r.text)
        assert got[r.doc_id][0] == label and got[r.doc_id][1] == pytest.approx(score, abs=1e-4)


def test_blocks_of_many_languages_are_cut(spark, monkeypatch):
    rows = [(i, "word " * 50) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    seen = common.map_text(df, "text", "n int", lambda part: {"n": [part.num_rows] * part.num_rows}, 100, 600).collect()
    assert max(r.n for r in seen) <= 3


def test_topk_plan_keeps_vectors_apart(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))], "vec_id long, embedding array<double>").repartition(4)
    plan = exact_topk.search(df, F.col("vec_id") % 50 == 0)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_missed_recall_takes_the_exact_way(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(8, 10))
    x = [b + 0.1 * rng.normal(size=10) for b in base for _ in range(40)] + list(rng.normal(size=(60, 10)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(embed_dedup, "audit", lambda *a: 0.5)
    unit = np.array(x) / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df, overlap=16).collect()}
    assert [got[i].n_links for i in range(len(x))] == (near.sum(1) - 1).tolist()
    assert {r.audited_recall for r in got.values()} == {1.0}


def test_plain_words_go_to_the_model_alone():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from offerlake.llm.packing import WordTokens

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, words = Tokenizer.from_file(path), WordTokens(path)
    texts = ["the Quick brown. fox's jumpedé startoftext endoftext unhappinesszzqx don't", "<|endoftext|> a z  \n I'LL (see) résumé, KK İx", "q" * 3000, "", "s't w"]
    for got, text in zip(words.encode(texts), texts):
        assert np.frombuffer(got, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids

    class Calls(list):
        def encode(self, text, **_):
            self.append(text)
            return whole.encode(text, add_special_tokens=False)

    words.tok = Calls()
    words.encode(["nevermet wordsss, Likethese here."])
    assert not [t for t in words.tok if t.isalpha()]
