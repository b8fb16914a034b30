"""Surrogates of entities that are hard to move: empty secrets, used-up forms, letters that grow in small form, listed names, other scripts."""

import pytest
from pyspark.sql import functions as F

from fieldwatch.llm import common, pii
from fieldwatch.llm.queries import SURROGATE_KEY

KEY = b"another key"


def swapped(spark, texts, key=KEY):
    common.ship(spark)
    rows = pii.surrogate_report(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), key)
    return [r.text for r in rows.orderBy("doc_id").collect()], rows


def held(texts):
    return {(kind, pii.canonical(kind, t[a:b])) for t in texts for kind, a, b in pii.entities(t)}


def test_blanks_are_no_secret(spark):
    texts = ["Password: ____________", "password: ------------ and more", "api_key=++++////____----", "token = ------------a"]
    new, _ = swapped(spark, texts)
    assert new[:3] == texts[:3] and new[3].startswith("token = ------------") and new[3] != texts[3]


def test_a_used_up_form_gets_longer_surrogates(spark):
    mails = [f"{a}@{b}.com" for a in "aeiou" for b in "aeiou"]
    texts = [f"mail {m} now" for m in mails] + ["Mail E@A.com"]
    new, rows = swapped(spark, texts)
    assert not held(texts) & held(new) and len(held(new)) == len(mails)
    assert all(kind == "email" for kind, _ in held(new)) and new[-1].lower() == f"mail {new[5].split(' ')[1]}"
    assert {r.n_entities for r in rows.collect()} == {1}


@pytest.mark.parametrize(("kind", "found"), [("email", "Ab.c@d.org"), ("phone", "+1 (212) 555-0100"), ("account", "4111 1111 1111 1111"), ("ssn", "123-45-6789"), ("ip", "10.0.0.1"), ("secret", "token=abcdefABCDEF0123"), ("person", "Mrs. Anna LEE")])
def test_longer_surrogates_of_every_kind(kind, found):
    value = pii.canonical(kind, found)
    new = {pii.Surrogates(KEY)[kind, value, pii.TRIES + k] for k in (1, 2, 3)}
    assert len(new) == 3 and all(len(n) > len(value) for n in new)
    assert all(len(pii.rendered(kind, found, n)) > len(found) for n in new)


def test_letters_that_grow_in_small_form(spark):
    texts = ["write to İlker.Öz@mail.example.com", "Mr. İlker Öz", "Mr. ΓΙΏΡΓΟΣ and Mr. Γιώργος"]
    new, _ = swapped(spark, texts)
    assert len(new[0]) == len(texts[0]) and not held(texts) & held(new) and len(held(new)) == 3


def test_no_entity_stays(spark):
    males = [f"Господин {n.capitalize()}" for n in pii.GIVEN["m", "cyrillic"]]
    texts = [*males, "Mr. Γιώργος", "Mr. 김철수", "Ms. 李明", "Mr. გიორგი", "Mr. Ææ", "Mr. John Smith", "Mr. Øø Ðð", "Señor Juan", "Mrs. דוד"]
    new, rows = swapped(spark, texts, SURROGATE_KEY)
    assert all(a != b for a, b in zip(texts, new, strict=True)) and {r.n_entities for r in rows.collect()} == {1}
    assert {n.split()[1].lower() for n in new[: len(males)]} == set(pii.GIVEN["m", "cyrillic"])
    assert not held(texts[len(males) :]) & held(new)


def test_full_names_give_way_to_real_ones(spark):
    common.ship(spark)
    values = [f"m:john {s}" for s in ("li", "smith", "weber")]
    values += [pii.permute("person", v, KEY) for v in values]
    real = spark.createDataFrame([("person", v) for v in values], "kind string, value string")
    again = {r.value: r.attempt for r in pii.attempts(real, KEY).collect()}
    known = pii.Surrogates(KEY)
    new = {known["person", v, again.get(v, 1)] for v in values}
    assert len(again) >= 3 and len(new) == len(values) and not new & set(values)
    assert pii.attempts(real.filter(F.lit(False)), KEY).count() == 0
