import pytest

from matchlens import config
from matchlens.session import new_shared_path
from matchlens.sources.csv import MISSING_TOKENS, read_inferred, read_matches
from matchlens.sources.matches import matches
from matchlens.sources.staging import staged_matches
from matchlens.sources.tables import load_tables, save_table


def write(tmp_path, *lines, bom=False):
    text = "\n".join([",".join(config.RAW_COLUMNS), *lines]) + "\n"
    (tmp_path / "raw.csv").write_text(text, encoding="utf-8-sig" if bom else "utf-8")
    return str(tmp_path / "raw.csv")


@pytest.mark.parametrize("bom", [False, True])
def test_missing_tokens_become_null(spark, tmp_path, bom):
    lines = [",".join([token] * 28) for token in MISSING_TOKENS if token]
    rows = read_matches(spark, write(tmp_path, *lines, bom=bom)).collect()
    assert len(rows) == len(MISSING_TOKENS) - 1
    assert all(value is None for row in rows for value in row)


def test_values_keep_their_type(spark, tmp_path):
    cells = {c: "Naples" if c in config.STRING_COLUMNS else "1.25" for c in config.RAW_COLUMNS}
    cells |= {"odds_home": "inf", "odds_draw": "", "home_shots": "many"}
    row = read_matches(spark, write(tmp_path, ",".join(cells.values()))).first()
    assert row["league"] == "Naples" and row["home_goals"] == 1.25
    assert row["odds_home"] == float("inf")
    assert row["odds_draw"] is None and row["home_shots"] is None


def test_derived_table_has_the_raw_columns(spark, sf_dir):
    df = matches(spark, sf_dir)
    assert tuple(df.columns) == (config.ROW_KEY, *config.RAW_COLUMNS)
    strings = tuple(c for c, kind in df.dtypes if kind == "string")
    assert strings == config.STRING_COLUMNS
    assert df.exceptAll(staged_matches(spark, sf_dir)).count() == 0


def test_tables_are_replaced_and_read_back(spark):
    folder = new_shared_path(spark, "test-tables")
    for rows in ([("a", 1, 50.0), ("b", 2, 60.0)], [("c", 3, 70.5)]):
        save_table(spark.createDataFrame(rows, "column_name string, null_count bigint, "
                                               "null_pct double"), folder, "missing_report")
    loaded = load_tables(spark, folder, ["missing_report"])["missing_report"]
    assert [tuple(r) for r in loaded.collect()] == [("c", 3, 70.5)]


def test_types_are_inferred(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text(
        'whole,gaps,number,text,nothing,wide,odd`name,"quoted, name"\n'
        '1,2,1.5,1,NA,99999999999999999999,inf,"a,b"\n'
        '-3,null,.5e3, x,,1,-Infinity,"say ""1"""\n')
    (tmp_path / "t" / "b.csv").write_text(
        'whole,gaps,number,text,nothing,wide,odd`name,"quoted, name"\n'
        '+7,5,NaN,1d,None,2,3.,N/A\n')
    df = read_inferred(spark, str(tmp_path / "t"))
    assert [kind for _, kind in df.dtypes] == [
        "bigint", "double", "double", "string", "double", "double", "double", "string"]
    inf = float("inf")
    assert sorted(map(tuple, df.collect())) == [
        (-3, None, 500.0, " x", None, 1.0, -inf, 'say "1"'),
        (1, 2.0, 1.5, "1", None, 1e20, inf, "a,b"), (7, 5.0, None, "1d", None, 2.0, 3.0, None)]


def test_types_of_no_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b\n")
    df = read_inferred(spark, str(tmp_path / "e.csv"))
    assert df.dtypes == [("a", "double"), ("b", "double")] and df.count() == 0
