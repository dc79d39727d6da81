"""Spelling variants, whitening and secrets against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import ROWS, clashing, documents
from oracle import connect, differences

from meetlake.llm import queries, secrets, spelling, whitening

SF_DIR = "/root/testdata/sf0.001"


def _variants(rows):
    """The contract of operator 11, word by word; near words by their one-letter deletions."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            n[run if h % 199 else run[:at] + run[at + 1 :]] += 1
    n = {w: c for w, c in n.items() if c >= 5 and len(w) >= 6}
    holes, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            holes[i, short].add(w)
            if short in n:
                near[w].add(short), near[short].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    # the hole must be at the same place in words of equal length, which holes' keys state
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-n[o], o))
            if n[best] >= 5 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), c, len(near[w]), n.get(form.get(w))) for w, c in n.items()}


def _got(rows):
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in rows}


def test_variants_of_all_documents(spark):
    got = _got(queries.op11_spelling(spark, SF_DIR).collect())
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert got == _variants(docs) and any(v[0] for v in got.values())


@pytest.mark.parametrize("tile_rows", [4096, 8])
def test_variants_chain_through_tiles(spark, tile_rows):
    """Chains of forms, edits at both ends and in both halves, long runs, ties, hot keys."""
    words = {"abcdefgh": 300, "abcdefg": 60, "abcdef": 10, "xabcdef": 2, "abcdefx": 5, "abXdef": 9}
    words |= {"ñandúes": 8, "ñanduées": 41, "ñandues": 41, "q" * 7000: 5, "q" * 7001: 26}
    words |= {f"prefix{a}{b}": 5 + 3 * (a == b) for a in "abcdefg" for b in "abcdefg"}
    rows = [(i, " ".join([w] * c)) for i, (w, c) in enumerate(words.items())]
    rows += [(None, "abcdeg " * 7), (4, None), (5, ""), (4, "zzzzzz " * 5), (4, "zzzzzz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = _got(spelling.variants(clashing(docs), tile_rows=tile_rows).collect())
    want = _variants(rows)
    assert got == want
    # the word h of its document hits may differ, so a chain is looked for, not named
    assert max(len(w) for w in got) >= 7000 and any(v[1] != v[0] and v[0] for v in got.values())


def test_tiles_hold_every_pair_once(spark):
    words = [f"abc{a}{b}{c}" for a in "abcdef" for b in "abcdef" for c in "abcdef"]
    rows = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint").repartition(5)
    got = [(r["word"], r["other"]) for r in spelling.near_words(rows, 40).collect()]
    want = [(x, y) for x in words for y in words if sum(p != q for p, q in zip(x, y)) == 1]
    assert len(got) == len(want) / 2
    assert {frozenset(p) for p in got} == {frozenset(p) for p in want}


def test_no_words(spark):
    assert spelling.variants(documents(spark, [])).collect() == []
    assert spelling.variants(documents(spark, [(1, "", "en", "a"), (2, None, "en", "a")])).collect() == []
    got = _got(spelling.variants(documents(spark)).collect())
    assert got == _variants([r[:2] for r in ROWS])


def _quantised(vectors):
    return np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors])


def _check_whitening(rows, vectors, components=8):
    x = _quantised(vectors).astype(object)
    n, total = len(x), x.sum(axis=0)
    y = ((n * x - total) / n).astype(float)
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, len(v))
    got = defaultdict(dict)
    for r in rows:
        got[r["vec_id"]][r["component"]] = r
    w = np.array([[got[i][c]["whitened"] for c in range(1, k + 1)] for i in sorted(got)])
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-6
    for i, row in zip(sorted(got), x):
        assert len(got[i]) == k
        for c, r in got[i].items():
            assert r["n"] == n and r["deviation"] == sum(int(d) ** 2 for d in n * row - total)
            assert r["explained"] == pytest.approx(e[c - 1] / np.trace(v), rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-9
    return w, y @ u[:, :k] / np.sqrt(e[:k])


def test_whitening_of_all_embeddings(spark):
    rows = queries.op12_whitening(spark, SF_DIR).collect()
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    assert len(rows) == 8 * len(vectors)
    got, want = _check_whitening(rows, [r["embedding"] for r in vectors])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-8


def test_eigenvectors_in_clusters():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    for values in (
        [9.0, 9 + 1e-6, 9 - 1e-6, *[5 + i * 1e-9 for i in range(7)], *np.linspace(1, 2, 30)],
        [4.0] * 20 + [1.0] * 20,
        [1.0] * 40,
        [1e6, *[1 + i * 1e-10 for i in range(39)]],
        [3.0, 1.0, *[0.0] * 38],
    ):
        a = (q * np.array(values)) @ q.T
        a = (a + a.T) / 2
        e, x = whitening.eigen(a)
        norm = np.abs(values).max()
        assert np.abs(x.T @ x - np.eye(40)).max() < 1e-14
        assert np.abs(a @ x - x * e).max() < 4e-15 * norm
        assert (np.diff(e) <= 0).all() and np.abs(e - sorted(values)[::-1]).max() < 1e-13 * norm
    e, x = whitening.eigen(np.zeros((3, 3)))
    assert (e == 0).all() and (x == np.eye(3)).all()


def test_float32_start_is_corrected():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(60, 60))
    a = a @ a.T
    e, x = whitening.eigen(a)
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    off = lambda u: np.abs(u.T @ a @ u - np.diag(np.diag(u.T @ a @ u))).max() / np.abs(a).max()
    assert off(rough) > 1e-8 and off(x) < 1e-14


def test_whitening_edges(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, [0.5, -0.25, 1.0]), (2, [1.5, 0.125, 1.0]), (3, None), (4, [nan, 1.0, 1.0]),
            (5, [None, 1.0, 1.0]), (6, []), (7, [1.0]), (None, [0.25, 2.0, 1.0]), (8, [inf, 0.0, 1.0]),
            (2, [1.5, 0.125, 1.0]), (9, [3e38, 0.0, 1.0])]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    v = v.selectExpr("*", "'x' as n", "1 as component", "2 as x", "3 as id", "4 as v")
    got = whitening.transformed(v).collect()
    assert sorted({(r["vec_id"] or 0) for r in got}) == [0, 1, 2] and len(got) == 12
    assert {r["n"] for r in got} == {4} and max(r["identity_error"] for r in got) < 1e-9
    # the third dimension has no variance
    assert {r["whitened"] for r in got if r["component"] == 3} == {0.0}
    assert len({tuple(r) for r in got if r["vec_id"] == 2}) == 3
    assert whitening.transformed(v.limit(0)).collect() == []
    single = whitening.transformed(v.filter("vec_id = 1")).collect()
    assert {(r["deviation"], r["whitened"], r["explained"]) for r in single} == {(0, 0.0, 0.0)}
    large = spark.createDataFrame([(i, [i * 1e12, 1.0]) for i in range(5)], "vec_id int, embedding array<double>")
    got = whitening.transformed(large).collect()
    assert {r["vec_id"]: r["deviation"] for r in got} == dict.fromkeys((0, 1, 3, 4)) | {2: 0}
    # far from zero with little spread: sums are exact, products are of centred values
    near = [(i, [1e9 + i / 64, 2.0**30 - (i * i % 7) / 64]) for i in range(50)]
    far = spark.createDataFrame(near, "vec_id int, embedding array<double>").repartition(7)
    _check_whitening(whitening.transformed(far).collect(), [r[1] for r in near])


_URL = "https://db.example.org/in"
SECRETS = [
    (1, 'x password: "abcdefghijkl", token=short'),
    (2, f"login = ann token=abcdef1 at {_URL}"),
    (3, f"token=abcdef1 at {_URL}"),
    (4, "login=ann token=abcdef1"),
    (5, f"é漢🙂 login=ann {'.' * 280} Secret : 'abcdef1' {'.' * 270} host=db.example.org"),
    (6, f"login=ann {'.' * 300} secret=abcdef1 {_URL}"),
    (7, f"AKIAABCDE12 api_key=0123456789ab {_URL} AKIA{'A' * 14} AKIAX"),
    (8, "secret=token: abcdefghijklmnop"),
    (9, "token=secret=abcdefghijklmnop"),
    (10, "0123456789abcdef 0123456789abcdeF0123456789abc" + "\n0" * 9),
    (11, f"user: bob 0123456789abc {_URL}"),
    (12, "PASSWORD=abcdefghijklſecret=mnopqrstuvwxyz paſſwd=abcdefghijklm toKen=abcdefghijklmn"),
    (13, None),
    (14, ""),
    (14, "token=abcdefghijklmnop " * 400),
    (None, "apikey = '" + "x" * 50_000 + "'"),
    (15, f"login=ann {_URL} " + "token=abcdefg " * 300),
]


def _spans(text):
    """Spans of one text by the docstring: all candidates against all parts."""
    found = []
    for k, (short, enough, group) in {
        "assign": (6, 12, 2), "access": (9, 18, 0), "hex": (12, 16, 0)
    }.items():
        for m in re.finditer(secrets.PATTERNS[k], text):
            size = len(m.group(group))
            if size >= short:
                found.append((m.start(), k if size >= enough else f"weak_{k}", m.end()))
    parts = [(s, k) for s, k, _ in found]
    for k, p in secrets.PARTS.items():
        parts += [(m.start(), k) for m in re.finditer(p, text)]
    roles = {
        "identifier": ("access", "weak_access", "identifier"),
        "secret": ("assign", "hex", "weak_assign", "weak_hex"),
        "endpoint": ("endpoint",),
    }

    def near(start, role):
        return any(k in roles[role] and abs(s - start) <= secrets.SCOPE for s, k in parts)

    def holds(start, kind):
        other = "secret" if kind == "weak_access" else "identifier"
        return kind in secrets.BASE or (near(start, other) and near(start, "endpoint"))

    kept = [f for f in found if holds(f[0], f[1])]
    return sorted(kept, key=lambda f: (f[0], secrets.KINDS.index(f[1])))


def _digest(rows):
    out = []
    for doc_id, text in rows:
        spans = _spans(text or "")
        said = lambda some: ",".join(f"{k}:{s}:{e}" for s, k, e in some)
        base = [f for f in spans if f[1] in secrets.BASE]
        n = Counter(k for _, k, _ in base)
        digest = hashlib.sha256(said(base).encode()).hexdigest()
        out.append((doc_id, n["assign"], n["access"], n["hex"], digest, said(spans)))
    return sorted(out, key=str)


def test_secrets_against_brute_force(spark):
    docs = spark.createDataFrame(SECRETS, "doc_id bigint, text string")
    got = secrets.scanned(clashing(docs)).collect()
    assert sorted((tuple(r) for r in got), key=str) == _digest(SECRETS)
    spans = {r["doc_id"]: r["spans"] for r in got}
    assert "weak_assign" in spans[2] and spans[3] == spans[4] == "" and "weak_assign" in spans[5]
    assert spans[6] == "" and "weak_access" in spans[7] and spans[8] == "" and "weak_hex" in spans[11]
    assert secrets.scanned(docs.limit(0)).collect() == []


def test_secrets_against_sql(spark, tmp_path):
    docs = spark.createDataFrame([r for r in SECRETS if r[0] != 14], "doc_id bigint, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = connect(SF_DIR)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert differences(secrets.scanned(docs), con, secrets.SQL) == ""


def test_secrets_of_all_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in queries.op13_secrets(spark, sf_dir).collect()), key=str)
    assert got == _digest(docs.collect()) and any(r[1] for r in got)


def test_secrets_use_no_python_workers(spark, monkeypatch):
    plans = []
    real = secrets.staged

    def noted(rows, purpose):
        plans.append(rows._jdf.queryExecution().toString())
        return real(rows, purpose)

    monkeypatch.setattr(secrets, "staged", noted)
    plans.append(queries.op13_secrets(spark, SF_DIR)._jdf.queryExecution().toString())
    assert len(plans) == 3 and not any("Python" in p or "Arrow" in p for p in plans)
