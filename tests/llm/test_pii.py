import hashlib
import random
import re

from parcelpulse.llm import pii

# the forms as the contract states them
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _counts(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def _brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in FORMS.items() for m in re.finditer(p, text) if _counts(k, m.group())]


def test_base_like_brute_force(spark):
    random.seed(0)
    parts = ["a@b.c", ".", "1", "12", "4111 1111 1111 1111", "4111111111111111", "+1 (234) 555-0000", "@", "x", "-", " ", "é", "😀", "255", "0.", "1.2.3.4", "+", "(", "\n"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(800)]
    texts += ["1" * 30_000, "a" * 50_000 + "@b.cc", "+1" + "(" * 20_000 + "23456789", "a@b.c " * 1500, "a." * 20_000, "1." * 20_000, "1 " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.spans_digest(pii.find(df)).collect():
        want = _brute(texts[r.doc_id])
        assert r.spans == ",".join(want) and r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in FORMS]


def _corpus(spark):
    rows = [(i, f"Please ask Zebulon or anyone at boss@x.org today number {i}.") for i in range(4)]
    rows += [(10 + i, f"Please ask anyone today about other things number {i}.") for i in range(60)]
    rows += [(90, "Zebulon2 Other@X.org once"), (91, None), (None, "boss@x.org"), (92, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_words_that_disclose_are_found(spark):
    df = _corpus(spark)
    got = {r.doc_id: r.spans for r in pii.spans_digest(pii.find(df)).collect()}
    assert got[0] == "email:32:42,term:11:18"  # not the words that are common without the entity
    assert got[10] == got[91] == got[92] == "" and got[90] == "email:9:20" and got[None] == "email:0:10"


def test_disclosure_by_brute_force(spark):
    import math

    df = _corpus(spark)
    rows = [r.text or "" for r in df.collect()]
    n, with_entity = len(rows), sum("boss@x.org" in t for t in rows)
    found = pii.find(df).where("doc_id = 0").first()
    treated = {rows[0][t.start : t.stop].lower() for t in found.pii_terms}
    for word in ("zebulon", "today", "anyone", "number"):
        both = sum("boss@x.org" in t and word in t.lower() for t in rows)
        alone = sum(bool(re.search(rf"(?<![a-z]){word}(?![a-z])", t.lower())) for t in rows)
        told = math.log(n * both / (with_entity * alone)) / math.log(n / with_entity)
        assert (told >= 0.9) == (word in treated)
    easy = pii.find(df, pii.Disclosure(threshold=-1.0)).where("doc_id = 0").first()
    assert len(easy.pii_terms) > len(found.pii_terms)
    assert not pii.find(df, pii.Disclosure(support=50)).where("size(pii_terms) > 0").count()


def test_sanitised_text_keeps_other_columns(spark, docs):
    long = "a@b.cc " * 700 + "end"
    out = {r.doc_id: r for r in pii.sanitise(docs([(1, "mail a@b.cc, call +1 (234) 555-0000!"), (2, None), (3, long), (4, "clean"), (4, "clean")])).collect()}
    assert out[1].text == "mail [EMAIL], call [PHONE]!" and out[2].text is None and out[4].text == "clean"
    assert out[3].text == "[EMAIL] " * 700 + "end" and out[3].key == "k" and out[3].n_tokens == 3
    both = pii.sanitise(_corpus(spark)).where("doc_id = 0").first().text
    assert both in ("Please ask  or anyone at [EMAIL] today number 0.", "Please ask [TERM] or anyone at [EMAIL] today number 0.")
    assert pii.sanitise(docs([(1, "a")]).limit(0)).count() == 0
    assert pii.sanitise(docs([(1, "a")])).columns == docs([(1, "a")]).columns


def test_terms_are_found_wherever_they_stand(spark):
    far = "and so on and on with more of the same plain words as before, then "
    rows = [(i, f"(Zebulon) wrote: {far * 3}boss@x.org is it. {far * 20}Ask 'Zebulon's' friend, Mary-Zebulon {i}.") for i in range(3)]
    rows += [(10 + i, f"Someone wrote: {far} number {i}. Ask a friend, Mary.") for i in range(60)]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(3):
        text = rows[i][1]
        assert [(t.start, t.stop, t.alone) for t in found[i].pii_terms] == [(m.start(), m.end(), True) for m in re.finditer("Zebulon", text)]
    assert all(not found[i].pii_terms for i in range(10, 70))


def test_no_python_on_the_main_path(spark):
    plan = pii.find(_corpus(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _lower_bound(both, term, z=0.84):
    p = both / term
    return (p + z * z / (2 * term) - z * (p * (1 - p) / term + z * z / (4 * term * term)) ** 0.5) / (1 + z * z / term)


def test_entities_of_one_and_two_documents_by_brute_force(spark):
    import math

    rows = [(i, f"Plain words stand here and say nothing of anyone, number {'abcdefghij'[i % 10] * 4}.") for i in range(400)]
    rows += [(500, "Plain words of Quentin and Aldous, one@x.org two@x.org, said here"), (501, "Aldous here"), (502, "three@x.org by Petronella, twice"), (503, "three@x.org for Petronella")]
    texts = [t for _, t in rows]
    held = {d: (t, re.findall(FORMS["email"].replace("(", "(?:"), t)) for d, t in rows if "@" in t}
    words = [set(re.findall(r"[^\W\d_]{3,}", t.lower())) for t in texts]
    want = {}
    for d, (text, mails) in held.items():
        want[d] = set()
        for mail in mails:
            n = sum(mail in t for t in texts)
            for w in set(re.findall(r"[^\W\d_]{3,}", re.sub(r"\S+@\S+", " ", text).lower())):
                both, term = sum(mail in t and w in s for t, s in zip(texts, words)), sum(w in s for s in words)
                share = both / term if both >= 3 else _lower_bound(both, term)
                if 1 + math.log(share) / math.log(len(texts) / n) >= 0.9:
                    want[d].add(w)
    found = {r.doc_id: {r.pii_text[t.start : t.stop].lower() for t in r.pii_terms} for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "quentin" in want[500] and "aldous" not in want[500] and "petronella" in want[502] and "here" not in want[500]
    assert {d: found[d] for d in held} == want and not any(found[d] for d in found if d not in held)


def test_columns_of_the_table_stay_whatever_their_names(spark):
    rows = [(1, "mail a@b.cc now", "mine", "k", 7), (2, "clean", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_text string, PII_key string, pii_spans int")
    out = {r.doc_id: r for r in pii.sanitise(df).collect()}
    assert tuple(out[1]) == (1, "mail [EMAIL] now", "mine", "k", 7) and tuple(out[2]) == rows[1]
