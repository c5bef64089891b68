import pytest
from pyspark.sql import functions as F

from dimhistory import Staging, accept_snapshot, merge_history
from dimhistory.errors import SchemaMismatch
from dimhistory.operators.screening import CORRUPT
from dimhistory.plans.load import apply_snapshot_jdbc
from dimhistory.sources import staging as staging_module
from dimhistory.sources.csv import csv_columns, history_columns, read_csv, write_csv
from dimhistory.sources.jdbc import JdbcTable
from util import AB, AB_SPEC, D0, D1, END, SPEC, ab, ab_history, collected

HEADER = " CustomerID ,Genre,Age,Annual_Income_(k$),Spending_Score"


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(HEADER + "\n1,Male,19,15,39\n2,\"Fe,male\",,16,81\n")
    return str(path)


def test_header_only(spark, csv):
    names = csv_columns(spark, csv)
    assert len(names) == 5 and names[-1] == "Spending_Score"
    assert history_columns(names, SPEC.scd_columns) == [
        "customerid", "genre", "age", "annual_income_(k$)", "spending_score",
        "sk_customerid", "effective_date", "expiration_date", "current_flag",
    ]


def test_schema_is_taken_by_name(spark, csv):
    from util import SOURCE

    shuffled = type(SOURCE)(list(reversed(SOURCE.fields)))
    df = read_csv(spark, csv, schema=shuffled)
    assert df.columns == SOURCE.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in SOURCE]
    assert sorted(tuple(r) for r in df.collect()) == [
        (1, "Male", 19, 15, 39), (2, "Fe,male", None, 16, 81),
    ]


def test_inference_is_an_option(spark, csv):
    assert {t for _, t in read_csv(spark, csv).dtypes} == {"string"}
    assert dict(read_csv(spark, csv, infer=True).dtypes)["age"] == "int"


def test_other_columns_are_refused(spark, csv):
    with pytest.raises(SchemaMismatch):
        read_csv(spark, csv, schema=AB)


def test_bad_value_fails_a_typed_read_and_is_rejected_from_text(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("k,a,b\n1,x,1\n2,y,n/a\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_csv(spark, str(path), schema=AB).collect()
    history = ab_history(spark, (1, "x", 1, 1, D0, END, True))
    known = ab_history(spark, (1, "x", 1, 1, D0, END, True), (2, "y", 2, 2, D0, END, True))
    for before in (history, known):  # of a new key, and of one whose version it must not close
        got = merge_history(before, read_csv(spark, str(path)), AB_SPEC, D1)
        assert collected(got) == collected(before)


def test_malformed_lines_of_a_text_read_are_rejected(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text("k,a,b\n1,x,1\n2,y\n3,z,3,extra\n4,w,4\n")
    text = read_csv(spark, str(path))
    assert text.columns == ["k", "a", "b", CORRUPT]
    accepted, rejected = accept_snapshot(text, AB, AB_SPEC)
    assert sorted(tuple(r) for r in accepted.collect()) == [(1, "x", 1), (4, "w", 4)]
    assert {r["reject_reason"] for r in rejected.collect()} == {"malformed line"}
    assert sorted(r[CORRUPT] for r in rejected.collect()) == ["2,y", "3,z,3,extra"]


def test_another_order_of_columns_in_a_second_file_is_refused(spark, tmp_path):
    (tmp_path / "one.csv").write_text("k,a,b\n1,x,1\n")
    (tmp_path / "two.csv").write_text("k,b,a\n2,2,y\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_csv(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")]).collect()


def test_write_and_read_back(spark, tmp_path):
    rows = [(1, "a,b", 1), (2, 'quo"te', None), (3, None, 3)]
    write_csv(ab(spark, *rows), str(tmp_path / "out"))
    got = read_csv(spark, str(tmp_path / "out"), schema=AB)
    assert sorted(tuple(r) for r in got.collect()) == rows


def test_staging_uses_the_session_folder(spark):
    with Staging(spark) as staging:
        assert staging.path.startswith(spark.conf.get("spark.checkpoint.dir"))
        df = staging.write(spark.range(5).select(F.col("id").alias("annual (k$)")), "x")
        assert df.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE|exist"):
        spark.read.parquet(staging.path).count()


class FakeContext:
    def __init__(self, master):
        self.master = master


class FakeSession:
    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    def __init__(self, master):
        self.sparkContext = FakeContext(master)


def test_no_local_folder_on_a_cluster():
    assert staging_module.shared_folder(FakeSession("local[4]"))
    with pytest.raises(RuntimeError):
        staging_module.shared_folder(FakeSession("spark://host:7077"))


class Recorder:
    """Stands for a DataFrameReader or a DataFrameWriter and remembers what it was told."""

    def __init__(self, first=None):
        self.said, self.first_row = {}, first

    def format(self, name):
        self.said["format"] = name
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def options(self, **options):
        self.said |= options
        return self

    def mode(self, mode):
        self.said["mode"] = mode
        return self

    def load(self):
        return self

    def save(self):
        self.said["saved"] = True

    def first(self):
        return self.first_row


class JdbcSession:
    def __init__(self, bounds):
        self.readers, self.bounds, self._jvm = [], bounds, FakeDatabase()

    @property
    def read(self):
        self.readers.append(Recorder(self.bounds))
        return self.readers[-1]


TABLE = JdbcTable("jdbc:some:db", "dim.customer", "some.Driver", {"user": "u", "password": "p"})


def test_jdbc_read_in_key_ranges():
    session = JdbcSession((1, 1000))
    TABLE.read(session, "sk_customerid", partitions=8)
    scan, bounds = session.readers[0].said, session.readers[1].said
    assert bounds["query"] == (
        "SELECT MIN(`sk_customerid`) AS lo, MAX(`sk_customerid`) AS hi FROM `dim`.`customer`"
    )
    assert scan == {
        "format": "jdbc", "url": "jdbc:some:db", "driver": "some.Driver", "user": "u",
        "password": "p", "dbtable": "`dim`.`customer`", "partitionColumn": "sk_customerid",
        "lowerBound": 1, "upperBound": 1001, "numPartitions": 8,
    }


def test_jdbc_read_of_an_empty_table_has_no_ranges():
    session = JdbcSession((None, None))
    TABLE.read(session, "sk", partitions=8)
    assert "partitionColumn" not in session.readers[0].said


def test_jdbc_writes():
    class Frame:
        write = Recorder()

    TABLE.overwrite(Frame)
    assert Frame.write.said["mode"] == "overwrite" and Frame.write.said["truncate"] is True
    assert Frame.write.said["saved"] and Frame.write.said["batchsize"] == 10_000
    Frame.write = Recorder()
    TABLE.append(Frame)
    assert Frame.write.said["mode"] == "append" and "truncate" not in Frame.write.said


class FakeDatabase:
    """Stands for the JVM: remembers statements and how the connection was left."""

    def __init__(self, fail_at=None):
        self.log, self.fail_at = [], fail_at

    def __getattr__(self, name):
        return self

    def __call__(self, *args):
        return self

    def quoteIdentifier(self, name):
        return f"`{name}`"

    def setAutoCommit(self, on):
        self.log.append(f"autocommit {on}")

    def executeUpdate(self, statement):
        self.log.append(statement)
        if self.fail_at and self.fail_at in statement:
            raise RuntimeError("refused")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


class JvmSession:
    def __init__(self, database):
        self._jvm = database


class ChangedRows:
    columns = ["k", "annual (k$)", "sk"]

    def __init__(self):
        self.write = Recorder()


def test_jdbc_changes_move_in_one_transaction():
    database, rows = FakeDatabase(), ChangedRows()
    TABLE.apply_rows(JvmSession(database), rows, ["k", "sk"])
    side = rows.write.said["dbtable"]
    assert side.startswith("`dim`.`customer_") and rows.write.said["mode"] == "errorifexists"
    assert database.log == [
        "autocommit False",
        f"DELETE FROM `dim`.`customer` WHERE EXISTS (SELECT 1 FROM {side} c "
        "WHERE c.`k` = `dim`.`customer`.`k` AND c.`sk` = `dim`.`customer`.`sk`)",
        "INSERT INTO `dim`.`customer` (`k`, `annual (k$)`, `sk`) "
        f"SELECT `k`, `annual (k$)`, `sk` FROM {side}",
        "commit",
        "close",
        "autocommit False",
        f"DROP TABLE IF EXISTS {side}",
        "commit",
        "close",
    ]
    other = ChangedRows()
    TABLE.apply_rows(JvmSession(database), other, ["k"])
    assert other.write.said["dbtable"] != side


def test_jdbc_changes_are_rolled_back_and_the_error_is_raised():
    database = FakeDatabase(fail_at="INSERT")
    with pytest.raises(RuntimeError, match="refused"):
        TABLE.apply_rows(JvmSession(database), ChangedRows(), ["k"])
    assert database.log.index("rollback") < database.log.index("close")
    assert database.log[-4:-2] == ["autocommit False", database.log[-3]]
    assert database.log[-3].startswith("DROP TABLE IF EXISTS")


def test_snapshot_into_a_database_writes_only_changes(spark):
    class Target:
        def read_active(self, session, staging, spec, partitions):
            assert partitions == 4
            rows = [(k, "x", k, k, D0, END, True) for k in (1, 2, 3)]
            return staging.write(ab_history(spark, *rows), "jdbc")

        def key_range(self, session, column):
            return (1, 7)  # closed rows hold larger keys

        def apply_rows(self, session, rows, keys):
            self.keys, self.rows = keys, collected(rows)

    target = Target()
    snapshot = ab(spark, (1, "x", 1), (2, "x", 9), (4, "n", 1))
    counts = apply_snapshot_jdbc(target, snapshot, AB_SPEC, D1, partitions=4)
    assert counts == {"INSERT": 1, "DELETE": 1, "UPDATE": 1, "REJECTED": 0}
    assert target.keys == ["k", "sk"]
    assert target.rows == [
        (2, "x", 2, 2, D0, D1, False),
        (3, "x", 3, 3, D0, D1, False),
        (4, "n", 1, 8, D1, END, True),
        (2, "x", 9, 9, D1, END, True),
    ]
    target.rows = None
    apply_snapshot_jdbc(target, ab(spark, *[(k, "x", k) for k in (1, 2, 3)]), AB_SPEC, D1, 4)
    assert target.rows is None
