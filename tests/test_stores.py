"""Quarantined lines, bucketed feature tables, and facts kept by day."""

import datetime as dt
import io
from contextlib import redirect_stdout


from buyhorizon import registry as R
from buyhorizon import session as S
from buyhorizon.plans import facts as FA
from buyhorizon.plans import training as TR
from buyhorizon.sources import io as IO
from buyhorizon.sources.fixtures import load_fixture_tables
from buyhorizon.spec import FIXTURE_SPEC as SPEC

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_broken_lines_are_set_aside_per_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("user_id,sku_id,a_date,a_num,a_type\n1,2,2001-03-04 05:06:07,3,1\nx,2,2001-03-04 05:06:07,3,1\n1,2,2001-03-04 05:06:07,3\n1,,2001-03-04 05:06:07,,1\n")
    (tmp_path / "in" / "b.csv").write_text("user_id,sku_id,a_date,a_num,a_type\n1,2,yesterday,3,1\n5,6,2001-03-04 00:00:00,3,1\n1,2,2001-03-04 05:06:07,3,1,9\n")
    rows, rejected = IO.scan_checked(spark, str(tmp_path / "in"), "action")
    assert {(r.user_id, r.sku_id, r.a_num) for r in rows.collect()} == {(1, 2, 3), (1, None, None), (5, 6, 3)}
    assert rows.select("a_type").count() == 3 and rows.columns == ["user_id", "sku_id", "a_date", "a_num", "a_type"]  # the same whatever is read
    for _ in range(2):
        IO.sink_rejected(rejected, "action", str(tmp_path / "rejected"))
    got = {r.file.rpartition("/")[2]: (r.table, r.rejected) for r in IO.rejected_counts(spark, str(tmp_path / "rejected")).collect()}
    assert got == {"a.csv": ("action", 4), "b.csv": ("action", 4)}
    lines = {r.line for r in rejected.collect()}
    assert "x,2,2001-03-04 05:06:07,3,1" in lines and "1,2,yesterday,3,1" in lines and len(lines) == 4


def test_only_a_rejected_line_has_its_file_stored(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("user_id,age,sex,user_lv_cd\n1,2,0,1\nx,2,0,1\n,,,\n3,2,0\n")
    held = []
    monkeypatch.setattr(IO, "stored", lambda df, name: held.append(S.stored(df, name)) or held[-1])
    rows, rejected = IO.scan_checked(spark, str(tmp_path / "in"), "user")
    assert [r._file is None for r in held[0].orderBy(IO.REJECTED).collect()] == [True, True, False, False]
    assert sorted((r.file.rpartition("/")[2], r.line) for r in rejected.collect()) == [("a.csv", "3,2,0"), ("a.csv", "x,2,0,1")]
    assert {tuple(r) for r in rows.collect()} == {(1, 2, 0, 1), (None, None, None, None)}


def test_lines_are_made_once_and_in_compiled_code(spark, tmp_path):
    day = dt.datetime(2001, 3, 4, 5, 6, 7, 80)
    spark.createDataFrame([(1, 97, day, -1), (2, 89, None, None), (None, 97 * 89, day, 3), (4, None, day, 3), (5, 5, day, 3)], IO.schemas.COMMENT).write.parquet(str(tmp_path / "in"))
    lines = R._lines_with_broken(spark.read.parquet(str(tmp_path / "in")), "o_id")
    at = "2001-03-04 05:06:07.000080"
    assert sorted(r.value for r in lines.collect()) == sorted([
        f"1,97,{at},-1", f"1,97,{at},-1,more", "2,89,,", "no-number,89,,", f",8633,{at},3", f",8633,{at},3,more", f"no-number,8633,{at},3",
        f"4,,{at},3", f"5,5,{at},3"])
    text = plan(lines)
    assert "* Generate" in text and "lambda" not in text and text.count("to_csv(") == 1


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    t = load_fixture_tables(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = TR.bucketed_families(t, SPEC, str(tmp_path / "families"), "test_families", 4)
        text = plan(df)
        assert text.count("SortMergeJoin") >= 3 and "Exchange" not in text
        again = IO.scan_bucketed(spark, "test_families_again", str(tmp_path / "families" / "oc"), spark.table("test_families_oc").schema, 4)
        both = spark.table("test_families_spine").join(again, "user_id", "left")
        assert "Exchange" not in plan(both) and both.count() == t.user.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = TR.build_table(t, SPEC, SPEC.train_anchor, [0], onehot=False).select(*df.columns)
    assert df.exceptAll(want).count() == 0 and df.count() == want.count()
    for name in ("spine", "oc", "cc", "ac", "again"):
        spark.sql(f"DROP TABLE test_families_{name}")


def test_an_added_slip_equals_a_full_build_and_joins_new_days_only(spark, tmp_path):
    t = load_fixture_tables(spark, SF)
    facts = FA.DayFacts(t, str(tmp_path / "days"))
    first = TR.family_table(t, SPEC, "AC", slips=[0], facts=facts)
    a0 = SPEC.train_anchor
    assert sorted(facts.added) == [(src, a0 - dt.timedelta(180), a0 - dt.timedelta(1), 180) for src in ("action", "order")]  # conversions need orders
    second = TR.family_table(t, SPEC, "AC", slips=[2], facts=facts)
    a2 = a0 - dt.timedelta(62)
    assert sorted(facts.added[2:]) == [(src, a2 - dt.timedelta(180), a0 - dt.timedelta(181), 62) for src in ("action", "order")]  # the days before, and no others
    for made, slip in ((first, 0), (second, 2)):
        want = TR.family_table(t, SPEC, "AC", slips=[slip])
        assert made.exceptAll(want).count() == 0 and made.count() == want.count()
    days = facts.of("action", SPEC, SPEC.anchors(a0, [0]))
    assert "PartitionFilters" in plan(days) and str(a0 - dt.timedelta(180)) in plan(days)
    assert len(facts.added) == 4
    later = FA.DayFacts(t, str(tmp_path / "days"))  # another process
    assert later.of("action", SPEC, SPEC.anchors(a0, [0, 2])).count() == FA.Facts(t).of("action", SPEC, SPEC.anchors(a0, [0, 2])).count() and not later.added


def test_days_written_before_a_loss_are_not_doubled(spark, tmp_path, monkeypatch):
    t = load_fixture_tables(spark, SF)
    anchors = SPEC.anchors(SPEC.train_anchor, [0])
    want = FA.Facts(t).of("order", SPEC, anchors)
    facts = FA.DayFacts(t, str(tmp_path / "days"))
    real = type(spark).createDataFrame
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            facts.of("order", SPEC, anchors)
        except RuntimeError:
            pass
    assert type(spark).createDataFrame is real and not facts.held(spark, "order")
    got = facts.of("order", SPEC, anchors)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_kept_tables_are_made_once_and_named_by_their_inputs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "store_root", lambda spark: str(tmp_path / "store"))
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    assert S.kept(spark, "x", make).count() == S.kept(spark, "x", make).count() == 3 and len(made) == 1
    spark.range(5).write.parquet(str(tmp_path / "in"))
    one = S.input_identity([spark.read.parquet(str(tmp_path / "in"))])
    assert one == S.input_identity([spark.read.parquet(str(tmp_path / "in"))])
    spark.range(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert one != S.input_identity([spark.read.parquet(str(tmp_path / "in"))])
    assert len(S.code_digest()) == 64
