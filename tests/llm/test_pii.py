import hashlib
import math
import random
import re

import edges
from pyspark.sql import functions as F

from tamarack.llm import pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(t - 9 * (t > 9) for t in twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    """(start, rank, end, kind, value) by the plain patterns."""
    return sorted(
        (m.start(), rank, m.end(), kind, m.group())
        for rank, (kind, pattern) in enumerate(PLAIN.items())
        for m in pattern.finditer(text)
        if valid(kind, m.group())
    )


def written(spans):
    return ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in spans)


def disclosed(rows, threshold=pii.THRESHOLD):
    """(doc_id, text) -> hidden terms, all counts by hand."""
    term = re.compile(r"[^\W_]+")
    near, entities, df = [], {}, {}
    for doc_id, text in rows:
        for t in set(term.findall((text or "").lower())):
            df[t] = df.get(t, 0) + 1
        terms = set(term.findall((text or "").lower()))
        held = {f"{kind}:{value.lower()}": terms for _, _, _, kind, value in base(text or "")}
        for e, terms in held.items():
            entities[e] = entities.get(e, 0) + 1
            near += [(doc_id, text, e, t) for t in terms]
    count, texts = {}, {}
    for _, text, e, t in near:
        count[e, t] = count.get((e, t), 0) + 1
        texts.setdefault((e, t), set()).add(text)
    n, hidden = len(rows), {}
    for doc_id, text, e, t in near:
        if len(texts[e, t]) < pii.SUPPORT or entities[e] == n:
            continue
        score = math.log(n * count[e, t] / (df[t] * entities[e])) / math.log(n / entities[e])
        if score >= threshold - 1e-12:
            hidden.setdefault((doc_id, text), set()).add(t)
    return hidden


def all_spans(text, terms):
    spans = base(text)
    if terms:
        pattern = re.compile(r"(?i)(?<![^\W_])(?:" + "|".join(sorted(terms)) + r")(?![^\W_])")
        for m in pattern.finditer(text):
            if not any(m.start() < s[2] and s[0] < m.end() for s in spans):
                spans = [*spans, (m.start(), 4, m.end(), "term", m.group())]
    return sorted(spans)


def corpus():
    rng = random.Random(4)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(words) for _ in range(40))
        if i % 12 == 0:
            text = text[:100] + f" Marlowe Quill writes from marlowe@quill.example.org in {text[100:]} Marlowe again"
        elif i % 12 == 1:
            text += f" call +49 30 12345678{i % 3}, card 4111 1111 1111 1111 from 10.0.0.{i} "
        rows.append((i, text))
    return rows + [
        (1000, "a@b.c%d@e.f x@y.z 1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4"),
        (1001, "é€漢 4111-1111-1111-1112 +1 (555) 123-4567 +12 a.b+c@d-e.co.uk"),
        (1002, "9" * 60000),
        (1003, "a." * 30000 + "@b.c"),
        (1004, ""),
        (1005, None),
        (0, rows[0][1]),  # a repeated row
    ]


def test_against_brute_force(spark):
    rows = corpus()
    hidden = disclosed(rows)
    assert any("marlowe" in terms and "quill" in terms for terms in hidden.values())
    got = sorted(tuple(r) for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = []
    for doc_id, text in rows:
        own = base(text or "")
        kinds = [sum(s[3] == k for s in own) for k in PLAIN]
        spans = all_spans(text or "", hidden.get((doc_id, text), ()))
        want.append((doc_id, *kinds, hashlib.sha256(written(own).encode()).hexdigest(), written(spans)))
    assert got == sorted(want)


def test_entities_of_documents(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.report(docs).collect():
        assert r.base_sha256 == hashlib.sha256(written(base(texts[r.doc_id])).encode()).hexdigest()


def test_sanitize(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hidden", F.lit(7))
    clean = pii.sanitize(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    texts = [r.text for r in clean.collect()]
    joined = " ".join(filter(None, texts)).lower()
    assert "marlowe" not in joined and "@quill" not in joined and "[email]" in joined and "[card]" in joined
    before = sorted(t for _, t in rows if t and not base(t))
    assert [t for t in before if t not in texts] == []  # clean documents stay as they are


def far_apart():
    """A name near an email address in five documents and far off in five, among others."""
    rng = random.Random(7)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows = []
    for i in range(200):
        text = " ".join(rng.choice(words) for _ in range(60))
        if i % 20 == 0:
            gap = "" if i % 40 == 0 else text
            text = f"{text} Ann Marlowe {gap} a.m@mail.example.org {text}"
        rows.append((i, text))
    return rows


def test_sanitize_hides_terms_far_from_the_entity(spark):
    rows = far_apart()
    clean = {r.doc_id: r.text for r in pii.sanitize(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("Marlowe" not in clean[i] and "[EMAIL]" in clean[i] for i in range(0, 200, 20))
    assert all(clean[i] == text for i, text in rows if i % 20)


def test_sanitize_hides_short_names(spark):
    rows = [(i, t.replace(" Ann Marlowe ", " Ng, Kim 李明 7b ")) for i, t in far_apart()]
    clean = {r.doc_id: r.text for r in pii.sanitize(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(name in clean[i] for i in range(0, 200, 20) for name in ("Ng", "Kim", "李明", "7b"))
    assert all(clean[i] == text for i, text in rows if i % 20)


def test_report_and_sanitize_hide_the_same_terms(spark):
    """Short names near an address, and names far off."""
    rows = [(i, t.replace(" Ann Marlowe ", " Kim Marlowe ")) for i, t in far_apart()] + [(500, "Kim at kim@x.org"), (501, "kim@x.org is Kim")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitize(docs).collect()}
    spans = {r.doc_id: [x.split(":") for x in r.spans.split(",") if x] for r in pii.report(docs).collect()}
    for doc_id, text in rows:
        told = {text[int(a) : int(b)] for kind, a, b in spans[doc_id] if kind == "term"}
        assert told == ({"Kim", "Marlowe"} if "Marlowe" in text else set())
        assert not any(name in clean[doc_id] for name in told)
    assert "Kim" in clean[500] and "Kim" in clean[501]  # Kim is in many documents without that address


def test_directories_count_one_address_for_all(spark):
    """Two texts with the same 1500 addresses: far fewer rows than addresses times terms."""
    rng = random.Random(2)
    people = [f"name{i} street{i} p{i}@mail.example.org" for i in range(1500)]
    rows = [(1, " ".join(people)), (2, " ".join(reversed(people))), (3, f"{people[7]} alone")]
    rows += [(10 + i, " ".join(f"word{rng.randrange(500)}" for _ in range(40))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.with_spans(docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text")).filter("size(spans) > 0")
    few = pii.representatives(found)
    assert sorted(r.df_e for r in few.collect()) == [2, 3]
    assert pii.together(found, few.select("entity")).count() < 20_000
    terms = [x for r in pii.report(docs).filter("doc_id < 3").collect() for x in r.spans.split(",") if x.startswith("term")]
    assert len(terms) == 2 * 2 * 1500


def test_odd_rows(spark):
    docs = edges.frame(spark)
    got = edges.collected(pii.report(docs))
    assert len(got) == len(edges.rows())
    assert got == edges.collected(pii.report(edges.clashing(spark)))
    assert pii.report(edges.empty(spark)).count() == 0
    assert edges.collected(pii.sanitize(docs)) == edges.collected(docs)
    assert pii.sanitize(edges.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark, root, capsys):
    pii.report(spark.read.parquet(f"{root}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
