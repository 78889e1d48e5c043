"""Each query over a whole data folder against a brute-force version of its contract."""

import base64
import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict
from functools import cache
from math import floor

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest

import corpus_pipeline
from screenlake.llm import queries as llm

SF = os.environ.get("SCREENLAKE_SF", "/root/testdata/sf0.001")
QUERIES = llm.queries()


def query(name):
    return next(f for k, f in QUERIES.items() if k.startswith(name + "_"))


@pytest.fixture(scope="session")
def result(spark):
    return cache(lambda name: query(name)(spark, SF).toPandas())


@cache
def loaded(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").df()


@cache
def texts():
    d = loaded("documents")
    return {int(i): (t if isinstance(t, str) else "") for i, t in zip(d["doc_id"], d["text"])}


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_sql(result, name):
    got = result(name.split("_")[0])
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(llm.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    norm = lambda df: sorted(tuple("-" if pd.isna(v) else str(int(v)) if isinstance(v, (int, float, np.number)) else str(v) for v in r) for r in df[columns].itertuples(index=False))
    assert norm(got) == norm(want)


def sets(n):
    out = {}
    for i, t in texts().items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t)) if x]
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    return out


def test_fingerprints(result):
    got = result("op2")
    ids = sorted(texts(), reverse=True)
    follow = {d: ids[(k + 1) % len(ids)] for k, d in enumerate(ids)}
    assert sorted(got["doc_id"]) == sorted(ids)
    weight = {i: Counter(t.lower().split() or [""]) for i, t in texts().items()}
    likeness = lambda a, b: sum((a & b).values()) / sum((a | b).values())
    off, own = [], {}
    for r in got.itertuples():
        t, nxt = texts()[r.doc_id], texts()[follow[r.doc_id]]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert own.setdefault(t, r.fingerprint) == r.fingerprint
        off.append(r.near_edited - likeness(weight[r.doc_id], Counter(edited.lower().split() or [""])))
        off.append(r.near_next - likeness(weight[r.doc_id], weight[follow[r.doc_id]]))
    assert abs(np.mean(off)) < 0.03 and np.sqrt(np.mean(np.square(off))) < 0.075


def test_toxicity(result):
    got, labels = result("op3").set_index("doc_id"), loaded("labels").dropna()
    assert sorted(got.index) == sorted(texts())
    held = {i for i in texts() if zlib.crc32(str(i).encode()) % 5 == 0}
    assert set(got.index[got["held_out"]]) == held
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    known = [(got["score"][int(i)], int(y)) for i, y in zip(labels["doc_id"], labels["toxic"]) if int(i) in held and int(i) in got.index]
    pos, neg = [s for s, y in known if y], [s for s, y in known if not y]
    if pos and neg:
        auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
        print("held-out AUC", auc, "recall", np.mean(np.array(pos) >= 0.5), "false", np.mean(np.array(neg) >= 0.5), len(pos), len(neg))
        assert auc > 0.9


def test_token_counts_and_pieces(result):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counts, trip = result("op4").set_index("doc_id"), result("op10").set_index("doc_id")
    assert sorted(counts.index) == sorted(trip.index) == sorted(texts())
    for i, t in texts().items():
        ids = model.encode(t)
        c = counts.loc[i]
        assert (c["n_bytes"], c["n_tokens"], c["over_limit"]) == (len(t.encode()), len(ids), len(ids) > 4096), i
        assert (trip.loc[i, "n_pieces"], trip.loc[i, "ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), i
        assert trip.loc[i, "same_text"] == (model.decode(ids) == t), i


def test_warc_digests(result):
    pages = loaded("pages")
    got = result("op5").set_index("page_id")
    for i, html in zip(pages["page_id"], pages["html"]):
        body = (html if isinstance(html, str) else "").encode()
        assert (got.loc[i, "payload_bytes"], got.loc[i, "payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def private(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m.group())) <= 15]


def secret(t):
    word = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    found = [("assign", *m.span()) for m in re.finditer(word + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(1)) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    return found + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]


@pytest.mark.parametrize("name, rule, kinds", [("op6", private, ("email", "ip", "card", "phone")), ("op9", secret, ("assign", "access", "hex"))])
def test_spans(result, name, rule, kinds):
    got = result(name).set_index("doc_id")
    assert sorted(got.index) == sorted(texts())
    for i, t in texts().items():
        base = rule(t)
        base.sort(key=lambda x: (kinds.index(x[0]), x[1]) if name == "op6" else (x[1], kinds.index(x[0])))
        line = ["%s:%d:%d" % x for x in base]
        r = got.loc[i]
        assert [r["n_" + k] for k in kinds] == [sum(b[0] == k for b in base) for k in kinds], i
        assert r["base_sha256"] == hashlib.sha256(",".join(line).encode()).hexdigest(), i
        every = [x.split(":") for x in r["spans"].split(",")] if r["spans"] else []
        assert not Counter(line) - Counter(":".join(x) for x in every), i
        assert all(0 <= int(s) < int(e) <= len(t) for _, s, e in every), i


def check_pieces(got, documents):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in documents.items()}
    parts, used = defaultdict(list), defaultdict(list)
    for r in got.itertuples():
        parts[r.doc_id].append((r.start, r.length))
        used[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert set(parts) == set(ids)
    for whole, spans in [*((len(ids[i]), p) for i, p in parts.items()), *((None, p) for p in used.values())]:
        at = 0
        for s, n in sorted(spans):
            assert s == at and n > 0
            at += n
        assert at == whole if whole is not None else at <= 2048
    total = [sum(n for _, n in p) for p in used.values()]
    waste = sum(0 if n & (n - 1) == 0 else 2048 - n for n in total)
    assert waste <= 0.01 * sum(total), waste / sum(total)


def test_packing(result):
    check_pieces(result("op8"), texts())


def components(found, least):
    """Brute force over sets: the smallest id that links lead to."""
    up = {i: i for i in found}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(found)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = found[a], found[b]
            if x and y and 100 * min(len(x), len(y)) >= least * max(len(x), len(y)) and 100 * len(x & y) >= least * len(x | y):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}


def test_jaccard(result):
    got, s = result("op7").set_index("doc_id"), sets(3)
    want = components(s, 90)
    assert {int(i): (int(r["n_shingles"]), int(r["component_id"])) for i, r in got.iterrows()} == {i: (len(s[i]), want[i]) for i in s}


def test_top_k(result):
    d = loaded("embeddings")
    rows = [(int(i), [floor(1024 * float(x)) for x in v]) for i, v in zip(d["vec_id"], d["embedding"]) if v is not None and np.isfinite(np.array(v, float)).all()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    want = []
    for i, q in rows:
        if i % 100 == 0:
            s = x @ np.array(q)
            want += [(i, r + 1, int(ids[j]), int(s[j])) for r, j in enumerate([j for j in np.lexsort((ids, -s)) if ids[j] != i][:10])]
    got = result("op1")
    assert sorted(got[["query_id", "rank", "vec_id", "score"]].itertuples(index=False, name=None)) == sorted(want)


def test_pipeline(spark, result, tmp_path):
    """Each stage's decisions are checked on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs.toPandas())
    start = loaded("documents")
    for df in kept[:-1]:
        assert list(df.columns) == columns
    clean = dict(zip(kept[0]["doc_id"], kept[0]["text"]))
    toxic = dict(zip(loaded("labels")["doc_id"], loaded("labels")["toxic"]))
    gone = set(start["doc_id"]) - set(clean)
    assert sum(toxic.get(i) == 0 for i in gone) <= 0.02 * sum(v == 0 for v in toxic.values())
    assert gone == set(result("op3").query("predicted == 1")["doc_id"])  # how good the classifier is, test_toxicity asks
    n5 = {}
    for i, t in clean.items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) if x]
        n5[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    want = components(n5, 80)
    assert set(kept[1]["doc_id"]) == {i for i in n5 if want[i] == i}
    assert sorted(kept[2]["doc_id"]) == sorted(kept[1]["doc_id"])
    assert not any(secret(t.replace("[SECRET]", "")) and secret(t) for t in kept[2]["text"] if isinstance(t, str))
    check_pieces(kept[3], {int(i): t or "" for i, t in zip(kept[2]["doc_id"], kept[2]["text"])})
