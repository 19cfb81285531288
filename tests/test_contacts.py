import pytest
from pyspark.sql import functions as F

from leadrank.functions.contacts import email_plausible, slot_column, title_rank
from leadrank.operators import contacts as C


@pytest.mark.parametrize(
    "first, last, email, kept",
    [
        ("", "kim", "info@mail.com", True),
        ("bo", "kim", "bk@mail.com", True),
        ("bo", "kim", "bkxy@mail.com", False),
        ("ana", "kim", "ana@mail", False),
        ("ana", "kim", "a@ana@mail.com", False),
        ("ana", "kim", "j.kim@mail.com", True),
        ("ana", "kim", "@mail.com", False),
    ],
)
def test_email_rule(spark, first, last, email, kept):
    rule = email_plausible(F.lit(first), F.lit(last), F.lit(email))
    assert spark.range(1).select(rule.alias("x")).first().x is kept


@pytest.mark.parametrize(
    "title, rank",
    [("vice president", 3), ("president", 2), ("co-founder", 1), ("owner and founder", 0), ("executive assistant", 2),
     ("chief executive officer", 0), ("vp sales", 3), ("engineer", 4), ("", 4)],
)
def test_title_rank(spark, title, rank):
    assert spark.range(1).select(title_rank(F.lit(title)).alias("x")).first().x == rank


def company(spark, *people):
    fields = ("title", "first_name", "last_name", "email")
    names, values = ["id"], [1]
    for slot, person in enumerate(people, 1):
        for field, value in zip(fields, person):
            names.append(slot_column(field, slot))
            values.append(value)
    return spark.createDataFrame([tuple(values)], ", ".join(f"`{n}` {'int' if n == 'id' else 'string'}" for n in names))


def test_compact_is_stable_and_blanks_the_rest(spark):
    df = company(
        spark,
        ("Engineer", "Ana", "Kim", "ana@mail.com"),
        (None, "Bo", None, " BO@mail.com "),
        (" Owner ", "Cy", "Moss", "nobody@mail"),
    )
    row = C.compact_contacts(df).first()
    assert [row[slot_column("email", i)] for i in (1, 2, 3)] == ["ana@mail.com", "bo@mail.com", ""]
    assert [row[slot_column("title", i)] for i in (1, 2, 3)] == ["engineer", "", ""]
    assert C.reachable(C.compact_contacts(df)).count() == 1
    assert df.where(C.has_plausible_contact()).count() == 1


def test_unreachable_company_is_dropped(spark):
    df = company(spark, ("CEO", "Ana", "Kim", "info@mail.com"), (None,) * 4, (None,) * 4)
    assert C.reachable(C.compact_contacts(df)).count() == 0
    assert df.where(C.has_plausible_contact()).count() == 0


def test_merge_leftovers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a_x int, a_y int, `b c` int")
    assert C.drop_merge_leftovers(df).columns == ["a", "b c"]
    with pytest.raises(ValueError, match="repeat"):
        C.drop_merge_leftovers(spark.createDataFrame([(1, 2)], "a_x int, a int"))


def test_contact_list(spark):
    df = spark.createDataFrame([(" a@b.c ",), ("a@b.c",), ("  ",), (None,)], "email string")
    assert [r.email for r in C.contact_list(df, "email").collect()] == ["a@b.c"]
