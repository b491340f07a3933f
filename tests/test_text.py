import itertools
import random

import pandas as pd
from hypothesis import given
from hypothesis import strategies as st

from refloom.functions import text as tx
from refloom.functions import values as vl
from refloom.operators.linkage import COMPARERS, diagnosis
from pyspark.sql import functions as F


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


def test_canonical(spark):
    assert one(spark, tx.canonical(F.col("a")), a="  «  x » – ﬁ n  wo- rd ‘q’ ") == '"x" - fi n wo-rd \'q\''


@given(st.text(alphabet="ab -–‘’«»ﬁœ   ¯'\"", max_size=20))
def test_canonical_is_idempotent(text):
    done = tx.python(tx.python(text, tx.SPACE_STEPS + tx.LIGATURE_STEPS), tx.SPACE_STEPS + tx.LIGATURE_STEPS)
    assert done == tx.python(text, tx.SPACE_STEPS + tx.LIGATURE_STEPS)


def test_columns_and_python_agree(spark):
    texts = ["Circular rnill", "O0o C) ti fi ü", "é ö ç [3 ]", "", "Sn yR"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for steps in (tx.OCR_EVAL, tx.OCR_LINK, tx.PUNCT_STEPS, tx.LIGATURE_STEPS, tx.UNACCENT_STEPS):
        assert [r[0] for r in df.select(tx.apply(F.col("t"), steps)).collect()] == [tx.python(t, steps) for t in texts]


def test_soft_equal(spark):
    same = lambda a, b: one(spark, tx.soft_equal(F.col("a"), F.col("b")), a=a, b=b)
    assert same("Circular fluid energy mill", "Circular fluid energy rni11")
    assert same("Co-operation", "cooperation")
    assert not same("mill", "rnill")
    assert not same("abcdefgh", "abcdefgx")


def test_clean_equal(spark):
    df = spark.createDataFrame([("A title of some length", "a title of sorne length."), ("short", "a much longer string"), ("", ""), (None, "x"), ("A title of some length", "title of some length")], "a string, b string")
    assert [r[0] for r in df.select(tx.clean_equal(F.col("a"), F.col("b"))).collect()] == [tx.clean_equal_text(r["a"], r["b"]) for r in df.collect()] == [True, False, False, False, True]


def test_fragment(spark):
    assert one(spark, tx.query_fragment(F.col("a")), a="\n a(b): c~d]e\n") == r"a\(b\)\: c?d\?e"
    assert one(spark, tx.query_fragment(F.col("a")), a=None) == ""


def test_diagnosis():
    assert diagnosis(None, None) is None
    assert diagnosis("x", None) == "NON_silence"
    assert diagnosis(None, "x") == "NON_bruit"
    assert diagnosis("x", "") == "NON_silence_vide"
    assert diagnosis("x", "x") == "OUI"
    assert diagnosis("abc-def", "abcdef") == "OUI_avec:rmhyph.OK"
    assert diagnosis("Long enough", "Long enough http://x", "tit") == "NON_+long_tit_http"
    assert diagnosis("Long enough ones", "Long enough ones!") == "OUI_avec:allongé.OK"
    assert diagnosis("an en-try “x”", "an entry \"x\"") == "OUI_avec:rmhyph.norpun.OK"
    assert diagnosis("abc", "xyz") == "NON_diff"


def test_accents():
    assert tx.compose_accents(pd.Series(["e´te", None])).tolist() == ["éte", None]


def test_values(spark):
    v = lambda c, **k: one(spark, c, **k)
    assert v(vl.iso_date(F.col("y"), F.col("m"), F.col("d")), y="1999", m="March", d="7") == "1999-03-07"
    assert v(vl.iso_date(F.col("y"), F.col("m"), F.col("d")), y="1999", m="Spring", d="7") == "1999"
    assert v(vl.period(F.col("y"), parity=True), y="1979") == "[1980 TO 1999]"
    assert v(vl.period(F.col("y")), y="1979-01") == "[* TO 1979]"
    assert v(vl.period(F.col("y")), y="x") == "UNKOWN_PERIOD"
    assert v(vl.page_suffixes(F.col("l"), F.col("f")), l="1245", f="1120") == ["1245", "245"]
    assert v(vl.page_suffixes(F.col("l"), F.col("f")), l="245", f="1120") == ["245", "5", "45"]
    assert v(vl.bare_doi(F.col("x")), x="https://doi.org/10.1/ab") == "10.1/ab"
    assert v(vl.is_isbn(F.col("x")), x="978-0-306-40615-7")
    assert v(vl.language_code(F.col("x")), x="De") == "de" and v(vl.language_code(F.col("x")), x="German") == "German"
    assert v(vl.split_name(F.col("x")), x="Ada B Lovelace").surname == "Lovelace"


def every_combination(gold, todo):
    """The diagnosis of unequal texts by trying all combinations of comparers, smallest first."""
    left = {(): (gold, todo, "")}
    for size in range(1, len(COMPARERS) + 1):
        level = {}
        for combo in itertools.combinations(COMPARERS, size):
            g, t, trace = left[combo[:-1]]
            ok, g, t = COMPARERS[combo[-1]](g, t)
            if ok:
                return f"OUI_avec:{trace}{combo[-1]}OK"
            level[combo] = (g, t, trace + combo[-1])
        left = level
    return "NON_diff"


def test_diagnosis_tries_every_combination():
    rng, letters = random.Random(5), "abO0l1I -.,;:é’'()/&"
    for _ in range(300):
        gold = "".join(rng.choices(letters, k=rng.randrange(1, 16)))
        todo = "".join((rng.choice(letters) if rng.random() < 0.12 else c) + ("" if rng.random() < 0.9 else rng.choice("- ,.")) for c in gold if rng.random() < 0.95) or "x"
        assert gold == todo or diagnosis(gold, todo) == every_combination(gold, todo)
