"""Literal grading table: (prediction, gold, grade), written by hand and not from the operator's constants."""

import pytest

from rollwise.functions.grading import with_accuracy

TABLE = [
    (r"\boxed{5}", "5", 1.0),
    (r"\boxed{5}", r"\boxed{5}", 1.0),
    (r"\boxed{6}", "5", 0.0),
    (r"first \boxed{3} then \boxed{9}", "9", 1.0),
    (r"first \boxed{3} then \boxed{9}", "3", 0.0),
    (r"\boxed{7} and an open \boxed{8", "7", 1.0),
    (r"\boxed{\frac{\sqrt{x^{2}}}{2}}", r"\boxed{\frac{\sqrt{x^{2}}}{2}}", 1.0),
    (r"\boxed{\frac{\sqrt{x^{2}}}{2}}", r"\frac{\sqrt{x^{2}}}{2}", 1.0),
    (r"\boxed{a_{b_{c_{d_{e}}}}}", "a_{b_{c_{d_{e}}}}", 1.0),
    (r"\boxed{a_{b_{c_{d_{e}}}}}", "a_{b_{c_{d_{f}}}}", 0.0),
    (r"\boxed{\{1, 2\}}", r"\{1,2\}", 1.0),
    (r"\boxed{\{5} and \} more}", r"\boxed{\{5}", 1.0),
    (r"\boxed{\boxed{4}}", "4", 1.0),
    (r"\boxed{1234}", "1,234", 1.0),
    (r"\boxed{1,234}", "1234", 1.0),
    (r"\boxed{1{,}234}", "1234", 1.0),
    (r"\boxed{12,345,678.5}", "12345678.5", 1.0),
    (r"\boxed{1,000,000}", "1000000", 1.0),
    (r"\boxed{1,23}", "123", 0.0),
    (r"\boxed{5}", "x = 5", 1.0),
    (r"\boxed{x = 5}", "5", 1.0),
    (r"\boxed{x = 5}", "x=6", 0.0),
    (r"\boxed{y = a + b}", "a+b", 1.0),
    (r"\boxed{12}", "12 cm", 1.0),
    (r"\boxed{12 cm}", "12", 1.0),
    (r"\boxed{12\text{ cm}}", "12", 1.0),
    (r"\boxed{12 square meters}", "12", 1.0),
    (r"\boxed{2x}", "2", 0.0),
    (r"\boxed{5}", "the answer is $5$", 1.0),
    (r"\boxed{5}", "The answer is 5.", 1.0),
    (r"\boxed{5}", "So we get $3$ and then $5$", 1.0),
    (r"\boxed{12}", "There are 12 apples", 1.0),
    (r"\boxed{13}", "There are 12 apples", 0.0),
    ("The final answer is $7$.", "7", 1.0),
    ("Final Answer is: 7. I hope this is right", "7", 1.0),
    ("the answer is 6\nno, the answer is 7", "7", 1.0),
    ("I could not solve it", "7", 0.0),
    ("", "7", 0.0),
    (r"\boxed{0.5}", r"\frac{1}{2}", 1.0),
    (r"\boxed{\dfrac{3}{4}}", "0.75", 1.0),
    (r"\boxed{1/3}", "2/6", 1.0),
    (r"\boxed{-3}", "3", 0.0),
    (r"\boxed{-3.0}", "-3", 1.0),
    (r"\boxed{50\%}", "50", 1.0),
    (r"\boxed{90^\circ}", "90", 1.0),
    (r"\boxed{\text{Paris}}", "Paris", 1.0),
    (r"\boxed{\text{blue whale}}", "blue whale", 1.0),
    (r"\boxed{Rome}", "Paris", 0.0),
    (r"\boxed{\left(1, 2\right)}", "(1,2)", 1.0),
    (r"\boxed{5}", "", None),
    (r"\boxed{5}", None, None),
    (None, "5", 0.0),
    (r"\boxed{}", "5", 0.0),
    # typed answers: separators never vanish, relations and several equations are no numbers
    (r"\boxed{12}", "1;2", 0.0),
    (r"\boxed{1;2}", "1;2", 1.0),
    (r"\boxed{35}", r"$3 \text{ or } 5$", 0.0),
    (r"\boxed{3, 5}", r"$3 \text{ or } 5$", 1.0),
    (r"\boxed{5, 3}", r"$3 \text{ or } 5$", 1.0),
    (r"\boxed{3 or 5}", "3, 5", 1.0),
    (r"\boxed{3}", "3 or 5", 0.0),
    (r"\boxed{5}", "3 and 5", 0.0),
    (r"\boxed{2}", "a=1, b=2", 0.0),
    (r"\boxed{a=1, b=2}", "a = 1, b = 2", 1.0),
    (r"\boxed{5}", r"x \geq 5", 0.0),
    (r"\boxed{x \geq 5}", r"x\geq 5", 1.0),
    (r"\boxed{5}", "x >= 5", 0.0),
    (r"\boxed{5}", "x < 5", 0.0),
    (r"\boxed{(1,2)}", "(1, 2)", 1.0),
    (r"\boxed{(2,1)}", "(1, 2)", 0.0),
    (r"\boxed{12}", "(1, 2)", 0.0),
    (r"\boxed{1,2}", "(1, 2)", 0.0),
    (r"\boxed{(0.5, 2)}", r"(\frac12, 2)", 1.0),
    (r"\boxed{(1, 2, 3)}", "(1, 2)", 0.0),
    (r"\boxed{[1, 2)}", "[1,2)", 1.0),
    (r"\boxed{[1, 2]}", "[1,2)", 0.0),
    (r"\boxed{(-\infty, 3]}", r"(-\infty,3]", 1.0),
    (r"\boxed{\{2, 1\}}", r"\{1, 2\}", 1.0),
    (r"\boxed{\{1, 3\}}", r"\{1, 2\}", 0.0),
    (r"\boxed{(1, 2)}", r"\{1, 2\}", 0.0),
    (r"\boxed{\{1, 1\}}", r"\{1, 2\}", 0.0),
    (r"\boxed{0.5}", r"\frac12", 1.0),
    (r"\boxed{\frac34}", "0.75", 1.0),
    (r"\boxed{\frac{3}4}", "0.75", 1.0),
    (r"\boxed{\frac1{4}}", "0.25", 1.0),
    (r"\boxed{-\frac{1}{2}}", "-0.5", 1.0),
    (r"\boxed{\frac{-1}{2}}", "-0.5", 1.0),
    (r"\boxed{1/0}", "1/0", 1.0),
    (r"\boxed{1/0}", "5", 0.0),
    (r"\boxed{.5}", "0.5", 1.0),
    (r"\boxed{-.5}", "-0.5", 1.0),
    (r"\boxed{1e3}", "1000", 1.0),
    (r"\boxed{1.5e-2}", "0.015", 1.0),
    (r"\boxed{+7}", "7", 1.0),
    (r"\boxed{2\sqrt{3}}", r"\sqrt{12}", 1.0),
    (r"\boxed{\frac{\sqrt{3}}{2}}", r"\sqrt{3}/2", 1.0),
    (r"\boxed{\sqrt2}", r"\sqrt{2}", 1.0),
    (r"\boxed{\sqrt{3}}", "3", 0.0),
    (r"\boxed{2\pi}", r"2\cdot\pi", 1.0),
    (r"\boxed{\frac{\pi}{4}}", r"\pi/4", 1.0),
    (r"\boxed{\pi}", "3.14", 0.0),
    (r"\boxed{\frac{a+b}{2}}", r"\frac{a+b}{2}", 1.0),
    (r"\boxed{a+\frac{b}{2}}", r"\frac{a+b}{2}", 0.0),
    (r"\boxed{12\text{ cm}^2}", "12", 1.0),
    (r"\boxed{3\,000}", "3000", 1.0),
    (r"\boxed{x = 1, 2}", "2, 1", 1.0),
]


@pytest.fixture(scope="module")
def graded(spark):
    rows = [(i, p, g) for i, (p, g, _) in enumerate(TABLE)]
    df = spark.createDataFrame(rows, "i int, pred string, gold string")
    return {r["i"]: r for r in with_accuracy(df, "pred", "gold", keep_parts=True).collect()}


@pytest.mark.parametrize("i", range(len(TABLE)))
def test_grade(graded, i):
    r = graded[i]
    assert r["reward"] == TABLE[i][2], (TABLE[i], r["pred_answer"], r["gold_answer"])


def test_duckdb_grades_alike(spark, graded):
    """The SQL form of the rules, over the same table."""
    import duckdb

    from rollwise.functions import grading as GR

    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, pred VARCHAR, gold VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, p, g) for i, (p, g, _) in enumerate(TABLE)])
    got = con.sql(f"""
      WITH ex AS (SELECT i, {GR.sql_extract('pred')} AS p, {GR.sql_extract('gold', gold=True)} AS g FROM t),
      kx AS (SELECT *, {GR.sql_kind('p')} AS pk, {GR.sql_kind('g')} AS gk FROM ex),
      vx AS (SELECT *, {GR.sql_elements('p', 'pk')} AS pe, {GR.sql_elements('g', 'gk')} AS ge FROM kx)
      SELECT i, p, g, CASE WHEN g IS NULL THEN NULL WHEN p IS NULL THEN 0.0 WHEN {GR.sql_equal('pk', 'gk', 'pe', 'ge')} THEN 1.0 ELSE 0.0 END FROM vx""").fetchall()
    assert {i: (p, g, r) for i, p, g, r in got} == {i: (r["pred_answer"], r["gold_answer"], r["reward"]) for i, r in graded.items()}
