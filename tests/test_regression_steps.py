"""The manual regression steps for batch transfers, with exact counts."""

import pytest

from tabletransfer.api import load, save
from tabletransfer.sources.generator import uuid_rows


def test_steps(spark, db):
    options = {"dbschema": db, "dbtable": "uuid_seq"}
    save(uuid_rows(spark.range(1000), "id"), options, "append")
    copy = load(spark, options)
    assert copy.count() == 1000 and len(copy.take(20)) == 20
    assert copy.dtypes == [("id", "string"), ("seq_no", "int"), ("created_d", "timestamp"), ("mv", "boolean")]

    second = options | {"dbtable": "uuid_seq_2"}
    save(copy, second, "overwrite")
    assert load(spark, second).count() == 1000
    save(copy.repartition(7), second, "overwrite")
    assert load(spark, second).count() == 1000

    third = options | {"dbtable": "uuid_seq_3"}
    none = load(spark, {"dbtable": f"select * from {db}.uuid_seq where seq_no < 0"})
    assert none.count() == 0
    save(none, third, "overwrite")
    assert load(spark, third).count() == 0

    one = load(spark, {"dbtable": f"SELECT * FROM {db}.uuid_seq limit 1"})
    save(one, options | {"dbtable": "uuid_seq_4"}, "append")
    for n in range(6, 11):
        assert load(spark, {"dbtable": f"SELECT * FROM {db}.uuid_seq limit {n}"}).count() == n
    for _ in range(5):
        save(uuid_rows(spark.range(1000), "id"), third, "append")

    counted = load(spark, {"dbtable": " union all ".join(
        f"select '{t}' name, count(*) n from {db}.{t}" for t in ["uuid_seq", "uuid_seq_2", "uuid_seq_3", "uuid_seq_4"])})
    assert {r.name: r.n for r in counted.collect()} == {
        "uuid_seq": 1000, "uuid_seq_2": 1000, "uuid_seq_3": 5000, "uuid_seq_4": 1}


def test_mode_is_mandatory(spark, db):
    with pytest.raises(ValueError, match="mode"):
        save(spark.range(1), {"dbtable": f"{db}.t"})
