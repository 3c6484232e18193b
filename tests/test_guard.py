import pytest

from cartwheel.operators import adhoc, guard
from cartwheel.plans import evaluation
from cartwheel.sources import readers
from demo_star import star_from_range


@pytest.fixture(scope="module")
def star(spark):
    return star_from_range(spark)


# statements to refuse, with the word the first reason must hold
REFUSED = {
    # a name in a literal, a common table outside its scope, a file, functions that leave the query, computed names
    "SELECT id, 'CTE [hidden]' AS t FROM hidden": "unknown: hidden",
    "SELECT *, 'CTE [secret]' AS t FROM parquet.`/root/testdata/sf0.001/nation.parquet`": "not allowed",
    "SELECT 1 FROM (WITH hidden AS (SELECT 1 AS x) SELECT * FROM hidden) a JOIN hidden b ON true": "unknown: hidden",
    "SELECT `reflect`('java.lang.System', 'getProperty', 'user.home') FROM DimStore": "Function not allowed: reflect",
    "SELECT reflect/**/('java.lang.System', 'getProperty', 'user.home')": "Function not allowed: reflect",
    "SELECT (SELECT try_reflect('java.lang.System', 'nanoTime')) FROM DimStore": "Function not allowed: ",
    "DROP TABLE gold.DimStore;": "SYNTAX",
    "DELETE FROM gold.FactOrderItem;": "SYNTAX",
    "UPDATE gold.DimProduct SET BasePrice = 0;": "SYNTAX",
    "INSERT INTO gold.DimStore VALUES (999,'x','y','z','2024-01-01');": "SYNTAX",
    "TRUNCATE TABLE gold.FactOrderItem": "SYNTAX",
    "CREATE TABLE gold.Hack (id int)": "SYNTAX",
    "SELECT * FROM gold.DimProduct; DROP TABLE gold.DimProduct;": "SYNTAX",
    "SELECT 1; SELECT 2": "SYNTAX",
    "SELECT 1) t; DROP TABLE DimProduct; --": "SYNTAX",
    "SELECT * INTO gold.Hack FROM gold.DimProduct;": "SYNTAX",
    "EXEC xp_cmdshell 'dir';": "SYNTAX",
    "SELECT * FROM gold.SecretSalaries;": "not allowed or unknown: gold.secretsalaries",
    "SELECT 1 FROM DimStore WHERE StoreKey IN (SELECT id FROM hidden)": "unknown: hidden",
    "SELECT 1 FROM (SELECT 1 x) UNION (SELECT id FROM hidden)": "unknown: hidden",
    "SELECT f.CreditCardNumber FROM gold.FactOrderItem f;": "UNRESOLVED_COLUMN",
    "SELECT Ssn FROM gold.DimCustomer": "UNRESOLVED_COLUMN",
    "WITH c AS (SELECT StoreKey FROM DimStore) SELECT Ssn FROM c": "UNRESOLVED_COLUMN",
    "SELECT * FROM master.dbo.sysobjects;": "unknown: master.dbo.sysobjects",
    "SELECT * FROM parquet.`/root/testdata/sf0.001/part.parquet`": "unknown: parquet",
    "SELECT * FROM range(10)": "Table-valued",
    "SELECT * FROM IDENTIFIER('Dim' || 'Store')": "Computed",
    "SELECT reflect('java.lang.System', 'nanoTime')": "Function not allowed",
    "": "Empty",
}
ALLOWED = [
    "SELECT 'reflect (x)' AS t, City FROM DimStore",
    "SELECT p.ProductName FROM gold.DimProduct p LIMIT 10;",
    "SELECT s.City, COUNT(*) AS n FROM gold.FactOrderItem f JOIN gold.DimStore s ON s.StoreKey = f.StoreKey "
    "GROUP BY s.City;",
    "SELECT SUM(f.LineTotal) AS rev FROM gold.FactOrderItem f;",
    "WITH c AS (SELECT StoreKey, sum(LineTotal) r FROM FactOrderItem GROUP BY StoreKey) SELECT * FROM c",
    "SELECT p.ProductName FROM gold.DimProduct AS p -- ; DROP TABLE gold.DimProduct\n;",
]


@pytest.mark.parametrize("sql", REFUSED)
def test_refused(star, sql):
    with pytest.raises(guard.Refused) as error:
        guard.guarded_sql(star, sql)
    assert REFUSED[sql] in str(error.value)


@pytest.mark.parametrize("sql", ALLOWED)
def test_allowed(star, sql):
    assert guard.guarded_sql(star, sql).rows.count() > 0


def test_schema_names_inside_literals_stay(star):
    sql = """SELECT 'gold.DimProduct' AS a, 'it\\'s gold.DimProduct' AS b, count(*) AS n /* gold.DimProduct's */
             FROM gold.DimProduct -- gold.DimProduct ' """
    row = guard.guarded_sql(star, sql).rows.first()
    assert (row.a, row.b) == ("gold.DimProduct", "it's gold.DimProduct") and row.n > 0


def test_cap(star):
    capped = guard.guarded_sql(star, "SELECT OrderId FROM FactOrderItem")
    assert capped.rows.count() == 1000 and capped.truncated.first()[0]
    small = guard.guarded_sql(star, "SELECT ProductName FROM DimProduct ORDER BY BasePrice DESC LIMIT 5")
    assert small.rows.count() == 5 and not small.truncated.first()[0]
    assert small.relations == ("dimproduct",)
    edge = guard.guarded_sql(star, "SELECT ProductKey FROM DimProduct", cap=18)
    assert edge.rows.count() == 18 and not edge.truncated.first()[0]


def test_safety_scoreboard(spark, star):
    cases = spark.createDataFrame([("", "reject", sql) for sql in REFUSED] + [("", "allow", sql) for sql in ALLOWED],
                                  readers.SAFETY)
    board = adhoc.safety_scoreboard(evaluation.run_statements(cases, star)).first()
    assert board.Clean and board.FalseRefusals == 0 and board.Malicious == len(REFUSED)


#: question, difficulty and a statement of the same meaning with other column names, order or joins
QUESTIONS = [
    (" What was total  revenue in 2024? ", "easy", "SELECT SUM(LineTotal) FROM FactOrderItem WHERE DateKey < 20250101"),
    ("Top 5 best-selling products by quantity", "medium",
     "SELECT ProductName, SUM(Quantity) n FROM FactOrderItem JOIN DimProduct USING (ProductKey) GROUP BY ProductName "
     "ORDER BY n DESC, ProductName LIMIT 5"),
    ("Doanh thu theo thành phố trong năm 2025", "medium",
     "SELECT City, SUM(LineTotal) FROM FactOrderItem JOIN DimStore USING (StoreKey) WHERE DateKey >= 20250101 "
     "GROUP BY City"),
    ("How many orders were placed in 2025?", "easy", "SELECT COUNT(*) FROM (SELECT DISTINCT OrderId FROM FactOrderItem "
                                                     "WHERE DateKey > 20250000)"),
    ("Revenue by payment method", "easy", "SELECT PaymentMethod p, SUM(LineTotal) r FROM FactOrderItem GROUP BY 1"),
    ("Revenue by membership tier in 2024", "medium",
     "SELECT MembershipTier, SUM(LineTotal) FROM FactOrderItem JOIN DimCustomer USING (CustomerKey) "
     "WHERE DateKey < 20250101 GROUP BY 1"),
    ("Monthly revenue in 2025", "hard",
     "SELECT Month, MonthName, SUM(LineTotal) FROM FactOrderItem JOIN DimDate USING (DateKey) WHERE Year = 2025 "
     "GROUP BY ALL"),
    ("Top 3 stores by revenue", "medium",
     "SELECT StoreName, SUM(LineTotal) r FROM FactOrderItem JOIN DimStore USING (StoreKey) GROUP BY 1 "
     "ORDER BY r DESC LIMIT 3"),
]


def test_question_scoreboard(spark, star):
    def board(entries):
        frame = spark.createDataFrame([("", "", level, question, sql) for question, level, sql in entries],
                                      readers.QUESTIONS)
        rows = adhoc.eval_scoreboard(evaluation.run_questions(frame, star)).collect()
        return {r.Difficulty: (r.Passed, r.Total, float(r.AccuracyPct)) for r in rows}

    assert board(QUESTIONS) == {"easy": (3, 3, 100.0), "medium": (4, 4, 100.0), "hard": (1, 1, 100.0),
                                "overall": (8, 8, 100.0)}
    unknown = ("Which shelf is empty?", "hard", "SELECT 1")
    assert board([QUESTIONS[0], unknown])["overall"] == (1, 2, 50.0)


def test_unknown_question_gets_the_fallback(star):
    rows = evaluation.ask("Which shelf is empty?", star).collect()
    assert len(rows) == 10 and rows[0].ProductName == "Brown Sugar Boba" and rows[0].BasePrice == 65000


def test_a_loaded_statement_goes_before_the_registered_answer(star):
    statements = {"which shelf is empty?": "SELECT COUNT(*) AS n FROM DimStore", "revenue by payment method": "DROP TABLE x"}
    assert evaluation.ask(" Which  shelf is empty? ", star, statements).collect()[0].n == 6
    with pytest.raises(guard.Refused):
        evaluation.ask("Revenue by payment method", star, statements)
