"""Tables of commits: crashes, repeated batches, upserts, versions."""

import random

import pytest

from flowtables import commits
from flowtables.tables import work_dir


@pytest.fixture
def table(spark):
    return commits.Table(spark, work_dir(spark))


def frame(spark, rows, schema="id long, v string, n int"):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_appends_and_overwrites(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    a, b = [(1, "a", 1)], [(2, "b", 2), (2, "b", 2)]
    table.append(frame(spark, a))
    table.append(frame(spark, b))
    before = table.read()
    assert rows(before) == sorted(a + b)
    table.overwrite(frame(spark, [(9, "z", 9)]))
    assert rows(table.read()) == [(9, "z", 9)] and rows(before) == sorted(a + b) and rows(table.read(0)) == a
    assert table.version() == 2


def test_a_batch_counts_once_whatever_fails(spark, table, monkeypatch):
    one, two = frame(spark, [(1, "a", 1)]), frame(spark, [(2, "b", 2)])
    table.append_once(one, 1)
    create = table.files.create
    monkeypatch.setattr(table.files, "create", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.append_once(two, 2)  # its files are there, its commit is not
    monkeypatch.setattr(table.files, "create", create)
    assert rows(table.read()) == [(1, "a", 1)]
    assert table.append_once(two, 2) == 1 and table.append_once(two, 2) is None and table.append_once(one, 1) is None
    assert rows(table.read()) == [(1, "a", 1), (2, "b", 2)]
    assert table.append_once(two, 2, writer="other") == 2  # batches are numbered by writer
    assert table.overwrite_once(one, 3) == 3 and table.overwrite_once(two, 3) is None and rows(table.read()) == [(1, "a", 1)]


def test_two_writers_never_share_a_version(spark, table):
    other = commits.Table(spark, table.root)
    create = table.files.create

    def late(file, text):
        if not other.commits():
            other.append(frame(spark, [(7, "other", 0)]))
        return create(file, text)

    table.files.create = late
    assert table.append(frame(spark, [(1, "a", 1)])) == 1
    assert rows(table.read()) == [(1, "a", 1), (7, "other", 0)]
    seven = other.version()
    table.files.create = create
    with pytest.raises(RuntimeError):
        table._commit("none", frame(spark, []).schema, mode="overwrite", batch=None, expect=seven - 1)


def test_upserts_against_a_dictionary(spark, table):
    rnd = random.Random(3)
    want = {}
    for n in range(6):
        batch = [(rnd.choice([None, *range(8)]), f"{n}-{i}", rnd.randrange(3)) for i in range(rnd.randrange(1, 12))]
        gone = [rnd.random() < 0.2 for _ in batch]
        df = spark.createDataFrame([(*r, g) for r, g in zip(batch, gone, strict=True)], "id long, v string, n int, gone boolean")
        table.upsert(df, ["id"], ["n"], batch=n, delete="gone")
        for r, g in sorted(zip(batch, gone, strict=True), key=lambda x: (x[0][2], x[1], x[0][1])):
            want[r[0]] = None if g else r
        assert rows(table.read()) == sorted((r for r in want.values() if r), key=repr)
        assert table.upsert(df, ["id"], ["n"], batch=n, delete="gone") is None
        if n == 3:
            table.compact()
            assert rows(table.read()) == sorted((r for r in want.values() if r), key=repr)
    table.append(frame(spark, [(0, "more", 1)]))
    assert len(rows(table.read().where("id = 0"))) == 1 + (want.get(0) is not None)


def test_columns_that_come_later(spark, table):
    table.append(frame(spark, [(1, "a", 1)]))
    table.append(spark.createDataFrame([(2, 0.5)], "id long, w double"))
    assert table.read().columns == ["id", "v", "n", "w"] and rows(table.read()) == [(1, "a", 1, None), (2, None, None, 0.5)]


def test_polling_versions(spark, table):
    seen = []
    each = lambda df, version: seen.append((version, rows(df)))
    for n in range(3):
        table.append(frame(spark, [(n, "x", n)]))
    latest = commits.start_after(table, "latest")
    at = commits.poll(table, commits.start_after(table, "earliest"), each)
    assert seen == [(n, [(n, "x", n)]) for n in range(3)] and at == 2
    table.append(frame(spark, [(5, "y", 5)]))
    seen.clear()
    assert commits.poll(table, at, each) == 3 and seen == [(3, [(5, "y", 5)])]
    seen.clear()
    commits.poll(table, latest, each)
    assert [v for v, _ in seen] == [3]
    seen.clear()
    commits.poll(table, commits.start_after(table, 1), each)
    assert [v for v, _ in seen] == [1, 2, 3]
    assert [(r.id, r.version) for r in table.added(1).orderBy("version").collect()] == [(2, 2), (5, 3)]
