import hashlib
import math
import random
from collections import defaultdict

import regex as re

from flowplan.llm import pii

from llm_tables import docs  # noqa: F401

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [
        (m.start(), i, m.end(), kind, m[0])
        for i, kind in enumerate(PATTERNS)
        for m in re.finditer(PATTERNS[kind], text or "")
        if valid(kind, m[0])
    ]
    return sorted(found)


def listed(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind, *_ in spans)


def brute_terms(texts):
    n, holds, stands, texts_of = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set)
    for text in texts:
        words = [w.lower() for w in re.findall(r"[\p{L}\p{N}]+", text)]
        for w in set(words):
            n[w] += 1
        entities, pairs = set(), set()
        for kind in PATTERNS:
            cuts = [m.span() for m in re.finditer(PATTERNS[kind], text) if kind != "card" or 12 <= len(re.sub("[^0-9]", "", m[0])) <= 19]
            for i, (a, b) in enumerate(cuts):
                if not valid(kind, text[a:b]):
                    continue
                value = text[a:b].lower() if kind == "email" else text[a:b] if kind == "ip" else re.sub("[^0-9]", "", text[a:b])
                before = text[cuts[i - 1][1] if i else 0 : a]
                after = text[b : cuts[i + 1][0] if i + 1 < len(cuts) else len(text)]
                near = re.findall(r"[\p{L}\p{N}]+", before)[-5:] + re.findall(r"[\p{L}\p{N}]+", after)[:5]
                entities.add((kind, value))
                pairs |= {(kind, value, w.lower()) for w in near}
        for e in entities:
            holds[e] += 1
        for p in pairs:
            stands[p] += 1
            texts_of[p].add(text)
    out = {}
    for (kind, value, w), k in stands.items():
        if len(texts_of[kind, value, w]) >= pii.SUPPORT and holds[kind, value] < len(texts):
            told = 1 - math.log(n[w] / k) / math.log(len(texts) / holds[kind, value])
            out[w] = max(out.get(w, -9), told)
    return {w: "removed" if d >= pii.REMOVE else "generalised" for w, d in out.items() if d >= pii.GENERALISE}


def brute(texts):
    told = brute_terms([t or "" for t in texts])
    rows = []
    for text in texts:
        text, found = text or "", base(text)
        more = [
            (m.start(), 4, m.end(), told[m[0].lower()])
            for m in re.finditer(r"[\p{L}\p{N}]+", text)
            if m[0].lower() in told and not any(a < m.end() and m.start() < b for a, _, b, *_ in found)
        ]
        counts = [sum(s[3] == k for s in found) for k in PATTERNS]
        rows.append((*counts, hashlib.sha256(listed(found).encode()).hexdigest(), listed(sorted([s[:4] for s in found] + more))))
    return rows, told


def rows_of(spark, docs, texts):
    found = pii.digest(pii.find_spans(docs(list(enumerate(texts))).repartition(3)))
    return [tuple(r)[1:] for r in sorted(found.collect(), key=lambda r: r.doc_id)]


EDGES = [
    None, "", " ", "a@b.c_d@e.f, x@y", "a@b@c.d.e. é😀 q@w.e", "1.2.3.4.5.6.7.8 999.1.1.1.2.3.4.5 0001.2.3.4", "256.1.1.1 10.0.0.255",
    "4111 1111 1111 1111, 4111-1111-1111-1112; 4111  1111", "12 34 56 78 90 12 34 56 78 90 12", "0" * 25 + " " + "0" * 12,
    "+1 (017) 555-7713 and +49 30 1234567 890123 45, +1 2", "+123456789 +1-2-3", "😀" * 50 + "me@site.org 😀 10.1.1.1",
    "x" * 60_000 + "@", "1" * 60_000, "a" * 30_000 + "@b" + ".c" * 30_000, "+1" + " " * 50_000, "1.2.3.4 " * 700, "+" * 3000 + "1 2 3",
]


def test_base_spans_match_plain_patterns(spark, docs):
    pieces = ["a@b.c", "@", ".", "-", "_", " ", "1", "23", "+", "1.2", "4111111111111111", "(5)", "555 12", "é", "😀", "\n", "%x"]
    rng = random.Random(5)
    texts = EDGES + ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(400)]
    found = rows_of(spark, docs, texts)
    assert [r[:5] for r in found] == [r[:5] for r in brute(texts)[0]]


def test_disclosing_terms_match_brute_force(spark, docs):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(300)]
    for i in range(12):
        texts[i] += f" Zebra, Quokka bureau mail kim@zoo.org {words[i]} Okapi."
    texts += ["an okapi and a bureau", "no copies " + texts[0], texts[0], texts[0], "kim@zoo.org quokka99"]
    texts += ["rare heron x@y.z"] * 20  # one text only, however often
    expected, told = brute(texts)
    assert told["zebra"] == "removed" and "heron" not in told and "w1" not in told
    assert rows_of(spark, docs, texts) == expected
    assert any("removed:" in r[-1] for r in expected)
    clean = pii.sanitised(pii.find_spans(docs([(i, t) for i, t in enumerate(texts)]))).collect()
    one = next(r.text for r in clean if r.doc_id == 3)
    assert "..., ... " in one and "<email>" in one and "kim@" not in one and "Zebra" not in one


def test_sanitised_text_keeps_the_rest_and_generalises(spark):
    rows = spark.createDataFrame(
        [(1, "A é 😀 Kim met 10.0.0.1 x7.", [], [("10.0.0.1", 14, 22)], [], [("0.0.1 x", 17, 24)],
          [("Kim", 6, 9, "generalised"), ("met", 10, 13, "removed"), ("x7", 23, 25, "generalised")])],
        "doc_id long, text string, " + ", ".join(f"{k} array<struct<value:string,start:int,stop:int>>" for k in pii.KINDS)
        + ", terms array<struct<value:string,start:int,stop:int,level:string>>",
    )
    assert pii.sanitised(rows).first().text == "A é 😀 <name> ... <ip>."


def test_null_ids_repeated_rows_clashes_and_empty(spark, docs):
    from pyspark.sql import functions as F

    rows = docs([(None, "a@b.c"), (None, None), (4, "a@b.c"), (4, "a@b.c")]).select("*", *[F.lit(1).alias(c) for c in ("email", "terms", "_h", "spans")])
    found = pii.digest(pii.find_spans(rows)).collect()
    assert sorted((str(r.doc_id), r.n_email, r.spans) for r in found) == [
        ("4", 1, "email:0:5"), ("4", 1, "email:0:5"), ("None", 0, ""), ("None", 1, "email:0:5")]
    assert pii.digest(pii.find_spans(docs([]))).count() == 0


def test_running_sums(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = [(i, [rng.randint(0, 99) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 127, 128, 129, 1000])]
    frame = spark.createDataFrame(rows, "i int, v array<int>")
    for r in pii.running_sums(frame, "v", "s").collect():
        total, sums = 0, []
        for x in r.v:
            total += x
            sums.append(total)
        assert r.s == sums


def test_query_over_all_documents(spark):
    import __spark_entry__ as registered

    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in registered.queries()["op13_pii"](spark, folder).collect()}
    expected = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows])[0], strict=True))
    assert found == expected and sum(sum(r[:4]) for r in expected.values()) > 5
