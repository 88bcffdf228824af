import random
import re

from helpers import docs_table, sentences, with_extras
from pyspark.sql import functions as F

from marketstream.llm import pii


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def plain_spans(text):
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def odd_texts():
    rnd = random.Random(4)
    noise = ["".join(rnd.choice("a@.1 +-(1b2é😀") for _ in range(60)) for _ in range(200)]
    return noise + [
        None, "", "a@b.com+x@c.de, 1.2.3.4.5.6.7.8 999.1.1.1", "😀 +1 (743) 555-3824 4111 1111 1111 1111 é a.b@c",
        "1" * 3000 + " " + "a" * 3000 + "@", "x@y.z@q.w +12345678901234567890 0000010.1.1.255", "ab@c.de " * 700,
    ]


def test_base_spans_equal_plain_search(spark):
    rows = list(enumerate(odd_texts()))
    found = pii.find(with_extras(docs_table(spark, rows)))
    got = {r.doc_id: r.s for r in found.select("doc_id", pii.span_text(F.col("spans")).alias("s")).collect()}
    assert got == {i: plain_spans(t) for i, t in rows}


def linked_corpus():
    """A name that stands beside one address in many texts, and alone in few."""
    texts = sentences(120, 9)
    for i in range(8):
        texts[i] += f" zelborg wrote to zel.borg@mail.example about word{i} "
    texts[8] += " only Zelborg here"
    return texts


def test_disclosing_terms_equal_brute_force(spark):
    rows = list(enumerate(linked_corpus()))
    docs = docs_table(spark, rows)
    rule = pii.Disclosure(generalise=0.9)
    found = pii._with_found(docs.select("doc_id", "text"), rule)
    got = {r.term: round(r.share, 9) for r in pii.disclosing_terms(docs, found, rule).collect()}
    import math

    total = len(rows)
    near, held = {}, {}
    for _, text in rows:
        terms = {w.lower() for w in re.findall(r"[^\W\d_]{3,}", text)}
        for t in terms:
            held[t] = held.get(t, 0) + 1
        at = text.find("zel.borg@mail.example")
        if at >= 0:
            end = at + len("zel.borg@mail.example")
            left, right = text[max(0, at - 80) : at], text[end : end + 80]
            left = re.sub(r"^[^\W\d_]+", "", left) if at > 80 else left
            right = re.sub(r"[^\W\d_]+$", "", right) if len(right) == 80 else right
            for t in {w.lower() for w in re.findall(r"[^\W\d_]{3,}", left + " " + right)}:
                near[t] = near.get(t, 0) + 1
    want = {}
    for t, n in near.items():
        share = math.log2(n * total / (8 * held[t])) / -math.log2(8 / total)
        if n >= rule.texts and share >= rule.generalise:
            want[t] = round(share, 9)
    assert got == want and "zelborg" in got


def test_sanitised_text(spark):
    texts = linked_corpus()
    rows = [*enumerate(texts), (900, None), (901, ""), (0, texts[0])]
    clean = pii.sanitise(with_extras(docs_table(spark, rows)), pii.Disclosure(generalise=0.9))
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got[900] is None and got[901] == ""
    assert all("[EMAIL]" in got[i] and "zel.borg" not in got[i] for i in range(8))
    assert not any("zelborg" in (t or "").lower() for t in got.values())
    assert [got[i] for i in range(20, 120)] == texts[20:]
    assert clean.count() == len(rows) and "linked" in clean.columns


def test_overlapping_spans_are_joined(spark):
    text = "call +4111 1111 1111 1111 now"
    clean = pii.sanitise(docs_table(spark, [(1, text)])).first().text
    assert "1111" not in clean and clean.startswith("call ") and clean.endswith(" now")


def test_empty_table(spark):
    assert pii.find(docs_table(spark, [])).count() == 0
    assert pii.sanitise(docs_table(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = pii.sanitise(docs_table(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
