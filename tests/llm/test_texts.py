import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import classes
from veridra.llm import dart, langid, lines, pii, toxicity

SF = "/root/testdata/sf0.01"


# ---- languages


def test_held_out_accuracy_and_edge_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.99 and got.score.between(0, 1).all()
    extra = spark.createDataFrame(
        [(-1, None, "en", 1), (-2, "", None, 2), (-3, "12 34 !", "en", 3), (-4, "the and " * 60_000, "en", 4), (-4, "the and " * 60_000, "en", 4), (None, "der die und das", None, 5)],
        "doc_id long, text string, lang string, score int",
    )
    both = docs.select("doc_id", "text", "lang", F.lit(0).alias("score")).union(extra)
    rows = {r["doc_id"]: r for r in langid.identify(both).where("doc_id < 0 OR doc_id IS NULL").collect()}
    assert [rows[i]["lang_pred"] for i in (-1, -2, -3)] == ["und"] * 3 and rows[-4]["lang_pred"] == "en"
    assert rows[None]["held_out"] is False
    assert langid.identify(docs.limit(0)).collect() == []
    assert {r["lang_pred"] for r in langid.identify(docs.limit(5).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_one_language_only(spark):
    docs = spark.createDataFrame([(i, f"some words number {i} in one language", "xx") for i in range(20)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(docs).collect()} == {"xx"}


# ---- toxicity


def test_chain_finds_toxic_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    parts = labels.join(docs, "doc_id").withColumn("test", F.col("doc_id") % 5 == 0)
    train = parts.where("NOT test").select("doc_id", "quality", "toxic")
    got = toxicity.classify(parts.select("doc_id", "text"), train, {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    p = got.join(parts.where("test").select("doc_id", "toxic"), "doc_id").toPandas()
    assert ((p.toxic == 1) == p.is_toxic).mean() > 0.97
    assert p[p.is_toxic].toxic.mean() > 0.9


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (2, "", "c"), (None, "bad words here", "c")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 1)], "doc_id long, toxic int, quality int")
    cats = {"toxic": F.col("toxic") == 1}
    got = toxicity.classify(docs, labels, cats).collect()
    assert len(got) == 4 and all(r["p_toxic"] == 0 and not r["is_toxic"] for r in got)
    assert len(toxicity.classify(docs, labels.fillna(0), cats).collect()) == 4
    assert toxicity.classify(docs.limit(0), labels, cats).collect() == []


# ---- lines


def boilerplate(rows, sites, chars):
    spread, first = {}, {}
    for n, (i, text, site) in enumerate(rows):
        for pos, line in enumerate((text if text is not None else "").split("\n")):
            t = line.strip(" ")
            if len(t) >= chars and text is not None:
                spread.setdefault(t, set()).add(site)
                first[t] = min(first.get(t, (9**9, 0)), (i, pos))
    out = {}
    for i, text, _ in rows:
        if text is not None:
            kept = [ln for pos, ln in enumerate(text.split("\n")) if not (len(spread.get(ln.strip(" "), set()) - {None}) >= sites and first[ln.strip(" ")] != (i, pos))]
            out[i] = "\n".join(kept)
    return out


def test_lines_against_brute_force(spark):
    rnd = random.Random(4)
    pool = [f"shared line number {i} of some length" for i in range(12)] + ["short", "", "   "]
    rows = [(i, "\n".join(rnd.choice([*pool, f"own line of document {i} {rnd.random()}"]) for _ in range(rnd.randint(0, 12))), rnd.choice(["a", "b", "c", "d", "e", "f", None])) for i in range(60)]
    rows += [(100, None, "a"), (101, "", "b"), (102, "\n".join(pool * 400), "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"hash": F.lit(1), "row": F.lit(2), "_gone": F.lit(3), "line": F.lit("x")})
    got = lines.drop_boilerplate(df, min_sites=4, min_chars=20)
    assert got.columns[: len(df.columns)] == df.columns
    got = {r["doc_id"]: r for r in got.collect()}
    want = boilerplate(rows, 4, 20)
    assert {i: got[i]["text"] for i in want} == want
    assert got[100]["text"] is None and got[100]["_n_lines"] == 0 and got[101]["_n_lines"] == 1
    assert lines.drop_boilerplate(df.limit(0)).collect() == []


def test_repeated_and_null_ids_keep_their_texts(spark):
    line = "one line that every site carries"
    rows = [(1, f"{line}\nx", "a"), (1, f"{line}\ny", "b"), (None, f"{line}\nz", "c"), (None, f"{line}\nz", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(r["text"] for r in lines.drop_boilerplate(df, min_sites=3).collect())
    assert len(got) == 4 and sum(line in t for t in got) in (1, 2) and {t.split("\n")[-1] for t in got} == {"x", "y", "z"}


def test_short_lines_go_by_a_wider_spread(spark):
    rows = [(i, f"Sign in\nown line {i}\n\n{'Share this' if i < 3 else ''}", f"s{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in lines.drop_boilerplate(df, min_sites=3, short_sites=4).collect()}
    assert got[0] == rows[0][1] and all(got[i] == rows[i][1].removeprefix("Sign in\n") for i in range(1, 6))


# ---- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def base(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


def test_base_spans_against_plain_patterns(spark):
    rnd = random.Random(3)
    bits = ["a", "@", ".", "b.c", "1", "2", "55", "-", " ", "+", "(", ")", "é", "🎉", "\n", "4111111111111111", "8.8.8.8", "_"]
    texts = [None, "", "a@b.com_x@y.z", "1.2.3.4.5.6.7.8", "0.0.0.255 256.1.1.1", "x" * 50_000, "1" * 30_000, "a." * 20_000 + "@b" + ".c" * 20_000, "+" + "1 " * 9_000]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    texts += ["a1 " * 700 + "8.8.8.8 x@y.z " * 900]
    df = spark.createDataFrame([(i, t or "") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r[0]: r[1] for r in pii.base_spans(df, "text").select("doc_id", pii.listed(F.col("_spans"))).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != base(t)] == []


def test_revealing_terms_go_and_common_ones_stay(spark):
    rows = [(i, f"memo {i} Zorblatt called about jane@corp.example.org yesterday {'xyz' * i}", "c") for i in range(6)]
    rows += [(i, f"nothing called yesterday about a memo {i}", "c") for i in range(6, 60)]
    rows += [(70, "copy quxling bob@corp.example.org", "c"), (71, "copy quxling bob@corp.example.org", "c"), (72, None, "c"), (73, "", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, entity string").withColumns({"row": F.lit(1), "term": F.lit(2)})
    got = {r["doc_id"]: r for r in pii.sanitise(df).collect()}
    assert len(got) == len(rows) and "Zorblatt" not in got[2]["_clean"] and "called" in got[2]["_clean"] and "[EMAIL]" in got[2]["_clean"]
    assert "quxling" in got[70]["_clean"]  # two copies are one context: no evidence
    assert got[72]["_clean"] == "" and got[72]["_spans"] == [] and got[8]["_clean"] == rows[8][1]
    assert pii.sanitise(df.limit(0)).collect() == []


def revealing(rows, remove_at=0.9, generalise_at=0.7, least=2):
    """{entity: {term: kind}} by counting over all pairs of documents, one document a row of distinct id."""
    n, docs = len(rows), []
    for i, t in rows:
        spans = [x.split(":") for x in base(t).split(",") if x]
        docs.append((t, {f"{k}:{t[int(a) : int(b)]}" for k, a, b in spans}, set(re.findall(r"[^\W_]+", t.lower()))))
    out = {}
    for e in set().union(*(d[1] for d in docs)):
        mine = [d for d in docs if e in d[1]]
        if len({t for t, _, _ in mine}) < least or len(mine) == n:
            continue
        ic = math.log2(n / len(mine))
        for w in set().union(*(d[2] for d in mine)):
            with_ = [d for d in mine if w in d[2]]
            pmi = math.log2(len(with_) * n / (sum(w in d[2] for d in docs) * len(mine)))
            if len({t for t, _, _ in with_}) >= least and round(pmi, 9) >= round(ic * generalise_at, 9):
                out.setdefault(e, {})[w] = "term" if round(pmi, 9) >= round(ic * remove_at, 9) else "general"
    return out


def test_disclosure_against_brute_force(spark):
    rnd = random.Random(12)
    words = [f"w{chr(97 + i)}" for i in range(26)]
    people = [(f"p{chr(97 + i)}@x.org", f"nick{chr(97 + i)}", f"town{chr(97 + i % 3)}") for i in range(6)]
    rows = []
    for i in range(160):
        t = [rnd.choice(words) for _ in range(rnd.randint(1, 8))]
        if rnd.random() < 0.3:
            mail, nick, town = rnd.choice(people)
            t += [mail] + [nick] * (rnd.random() < 0.9) + [town] * (rnd.random() < 0.9)
            rnd.shuffle(t)
        rows.append((i, " ".join(t)))
    want = revealing(rows)
    assert any("general" in v.values() for v in want.values()) and any("term" in v.values() for v in want.values())
    got = pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.listed(F.col("_spans"))).collect()
    for i, listed in got:
        text, found = rows[i][1], base(rows[i][1])
        taken = [(int(a), int(b)) for _, a, b in (x.split(":") for x in found.split(",") if x)]
        kinds = {}
        for e in (f"email:{text[a:b]}" for a, b in taken):
            for w, k in want.get(e, {}).items():
                kinds[w] = "term" if "term" in (k, kinds.get(w)) else k
        own = [(m.start(), m.end(), kinds[m[0].lower()]) for m in re.finditer(r"[^\W_]+", text) if m[0].lower() in kinds and all(m.end() <= a or b <= m.start() for a, b in taken)]
        every = sorted([*found.split(","), *(f"{k}:{a}:{b}" for a, b, k in own)], key=lambda x: int(x.split(":")[1]) if x else -1)
        assert listed == ",".join(x for x in every if x), i


def test_secrets(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    cases = [f'token = "{key}" x', "a" * 40, "1" * 40, f"{key[:19]} x", f"mail {key}@a.org", f"é{key}", f"{key},{key.upper()}"]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.sanitise(df).collect()}
    assert got[0]["_clean"].startswith('token = "[SECRET]"') and got[0]["_base"] == []
    assert [sum(x["kind"] == "secret" for x in got[i]["_spans"]) for i in range(7)] == [1, 0, 0, 0, 0, 0, 2]
    assert got[4]["_clean"] == "mail [EMAIL]"


def test_terms_reveal_wherever_they_stand(spark):
    far = "nothing called yesterday about a memo of some length " * 4
    rows = [(i, f"Zorblatt wrote: {far}{i}{far} jane@corp.example.org", "c") for i in range(5)]
    rows += [(10 + i, f"{far} number {i}a. Contact Li x7 agent or bo@corp.example.org", "c") for i in range(5)]
    rows += [(20, f"quxling {far} eve@corp.example.org", "c")] * 3 + [(21, f"quxling {far} eve@corp.example.org", "c")]
    rows += [(100 + i, f"{far} agent or contact {i}", "c") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, entity string")
    got = {r["doc_id"]: r["_clean"] for r in pii.sanitise(df).collect()}
    assert not any("Zorblatt" in got[i] for i in range(5)) and all("called yesterday" in got[i] for i in range(5))
    assert not any(t in got[10 + i] for i in range(5) for t in ("Li ", "x7")) and "agent or" in got[10]
    assert "quxling" in got[20] and got[100] == rows[-60][1]


def test_repeated_rows_count_alike(spark):
    rows = [(i, f"filler row {i} about nothing") for i in range(400)]
    rows += [(500, "ann@x.org met Zorblatt")] * 60 + [(501, "Zorblatt knows ann@x.org well")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r["_clean"] for r in pii.sanitise(df).where("doc_id >= 500").collect()]
    assert len(got) == 61 and not any("Zorblatt" in t for t in got)


def test_many_entities_meet_many_terms(spark, monkeypatch):
    mails = " ".join(f"m{i}@x.org" for i in range(60))
    rows = [(i, f"{mails} Zorblatt {'same words ' * 5} own{i}") for i in range(3)] + [(10 + i, f"same words and {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r["doc_id"], r["_clean"]) for r in pii.sanitise(df).collect())
    monkeypatch.setattr(pii, "PAIRS", 50)
    monkeypatch.setattr(pii, "STRIDE", 3)
    monkeypatch.setattr(pii, "BLOCK", 7)
    assert sorted((r["doc_id"], r["_clean"]) for r in pii.sanitise(df).collect()) == want
    assert all("Zorblatt" not in t and "@" not in t for i, t in want if i < 10)


def test_a_very_long_text(spark):
    rnd = random.Random(6)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    parts = [rnd.choice(vocab) if rnd.random() < 0.98 else f"mail{rnd.randrange(50)}@x.org" for _ in range(800_000)]
    long = " ".join(parts) + " Zorblatt"
    rows = [(1, long), (2, "Zorblatt mail1@x.org"), *((10 + i, " ".join(vocab[i * 50 : i * 50 + 50])) for i in range(60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.perf_counter()
    got = {r["doc_id"]: r for r in pii.sanitise(df).where("doc_id < 10").collect()}
    took = time.perf_counter() - began
    assert len(long) > 4_700_000 and took < 60, took
    assert got[1]["_clean"] == " ".join("[EMAIL]" if "@" in p else p for p in parts) + " [REMOVED]"
    assert got[2]["_clean"] == "[REMOVED] [EMAIL]"


# ---- near-duplicates


def test_near_duplicates_against_all_pairs(spark):
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for _ in range(25):
        base_text = [rnd.choice(vocab) for _ in range(rnd.choice([2, 4, 5, 40, 200]))]
        for _ in range(rnd.randint(1, 6)):
            t = list(base_text)
            for _ in range(rnd.choice([0, 0, 1, 2, 8])):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            rows.append((i, " ".join(t) + rnd.choice(["", ".", "!"])))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "..."), (i + 3, "spam " * 3000), (i + 4, "spam " * 3000 + "x"), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(1), "band": F.lit(2), "class_id": F.lit(3)})
    got = {r["doc_id"]: r["class_id"] for r in dart.near_duplicates(df).collect()}
    assert got == classes(rows)
    assert dart.near_duplicates(df.limit(0)).collect() == []
    assert dart.near_duplicates(df.withColumn("doc_id", F.lit(None).cast("long"))).collect() == []


def test_a_large_family_of_near_copies(spark):
    rnd = random.Random(21)
    base_text = [f"w{rnd.randrange(5000)}" for _ in range(140)]
    rows = []
    for i in range(120):
        t = list(base_text)
        for _ in range(rnd.choice([0, 1, 2, 3, 5, 8])):
            t[rnd.randrange(len(t))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    rows += [(200 + i, rows[3][1]) for i in range(150)] + [(None, rows[0][1]), (400, rows[5][1]), (400, rows[7][1])]
    got = dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == classes(rows)
    assert {r["doc_id"]: r["n_copies"] for r in got}[3] == len({i for i, t in rows if t == rows[3][1] and i is not None})


def test_no_link_of_a_hot_bucket_is_lost(spark, monkeypatch):
    """Near copies of one page at every distance from it: many are alike to some, not to others."""
    rnd = random.Random(5)
    page = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(260):
        t, at = list(page), rnd.randrange(0, 110)
        for k in range(at, min(at + rnd.choice([0, 3, 6, 9, 12, 15]), 120)):
            t[k] = f"x{rnd.randrange(4)}k{k}"
        for _ in range(rnd.choice([0, 0, 1, 2])):
            t[rnd.randrange(120)] = f"y{rnd.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = classes(rows)
    assert len(set(want.values())) > 5
    for leaders, dealt in ((4, 2_000), (1, 10)):
        monkeypatch.setattr(dart, "LEADERS", leaders)
        monkeypatch.setattr(dart, "DEALT", dealt)
        assert {r["doc_id"]: r["class_id"] for r in dart.near_duplicates(df).collect()} == want


def test_a_chain_of_links_is_one_class(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[20 * k : 20 * k + 240])) for k in range(8)]
    assert {r["class_id"] for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}


@pytest.mark.parametrize("n", [3, 300])
def test_signatures_estimate_weighted_similarity(n):
    import numpy as np
    import pyarrow as pa

    from tests.llm.helpers import shingle_counts, weighted_jaccard
    from veridra.llm.shingles import shingles, text_bytes, words

    rnd = random.Random(n)
    a, b = [], []
    for _ in range(40):
        t = [rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(n)]
        u = list(t)
        u[rnd.randrange(n)] = "zz"
        a.append(" ".join(t * 2))
        b.append(" ".join(u * 2))
    raw, starts = text_bytes(pa.array(a + b))
    sig = dart.signatures(*dart.weighted(*shingles(*words(raw, starts)[:2])), 80)
    errors = [(sig[i] == sig[40 + i]).mean() - weighted_jaccard(shingle_counts(a[i]), shingle_counts(b[i])) for i in range(40)]
    assert abs(np.mean(errors)) < 0.02


def test_tables_of_texts_are_few_files(spark, monkeypatch):
    """A shuffle of many parts must not make as many files of a small table: near-dedup keeps some thirty tables."""
    kept, write = [], dart.stored

    def stored(df):
        kept.append(df.rdd.getNumPartitions())
        return write(df)

    monkeypatch.setattr(dart, "stored", stored)
    most = 8 * spark.sparkContext.defaultParallelism
    wide = spark.range(50).repartition(3 * most)
    assert dart._by_text(wide, 50).count() == 50
    assert kept == [most]
    assert dart._by_text(wide, 10**6).count() == 50
    assert kept[1] == min(3 * most, max(most, 500))
