"""Numbers by their formats."""

import pytest

from colscope.functions.cellformat import BUILT_IN, shown_number

CASES = [
    ("1234.5", "General", "1234.5"), ("-0.000001", "General", "-0.000001"), ("123456789012", "General", "1.23457E+11"), ("0.1234567891234", "General", "0.123456789"), ("12345678.123456", "General", "12345678.12"), ("0", "General", "0"),
    ("1234.5", "0", "1235"), ("-1234.4", "0", "-1234"), ("0.4", "0", "0"), ("-0.4", "0", "0"), ("7", "000", "007"), ("0", "#", ""), ("0.5", "#.00", ".50"), ("0.5", "0.0#", "0.5"), ("0.25", "0.0#", "0.25"),
    ("1234567.891", "#,##0.00", "1,234,567.89"), ("-1234567.891", "#,##0.00", "-1,234,567.89"), ("12", "#,##0", "12"), ("0", "#,##0.00", "0.00"), ("1234567", "#,##0,", "1,235"), ("1234567", "0.0,,", "1.2"), ("5", "0,000", "0,005"),
    ("0.256", "0%", "26%"), ("0.256", "0.0%", "25.6%"), ("-0.05", "0.00%", "-5.00%"), ("2", "0%", "200%"),
    ("12345", "0.00E+00", "1.23E+04"), ("0.00012", "0.00E+00", "1.20E-04"), ("0", "0.00E+00", "0.00E+00"), ("9.999", "0.0E+0", "1.0E+1"), ("12345", "##0.0E+0", "12.3E+3"), ("12345", "0E-0", "1E4"),
    ("1234", "#,##0 ;(#,##0)", "1,234 "), ("-1234", "#,##0 ;(#,##0)", "(1,234)"), ("-5.5", "#,##0.00;[Red](#,##0.00)", "(5.50)"), ("0", '0;-0;"none"', "none"), ("0", "0;-0;", ""), ("abc", "0;-0;0;@\" !\"", "abc !"), ("abc", "0.00", "abc"), ("abc", "@", "abc"), ("12.50", "@", "12.5"),
    ("1234.5", '"$"#,##0.00', "$1,234.50"), ("1234.5", "[$€-407] #,##0.00", "€ 1,234.50"), ("12", '0" units"', "12 units"), ("12", r"0\x", "12x"), ("7", "_(0_)", " 7 "), ("5", "*-0", "5"), ("150", "[>100]\"big\";0", "big"), ("50", "[>100]\"big\";0", "50"),
    ("0.5", "# ?/?", "1/2"), ("2.25", "# ?/?", "2 1/4"), ("3", "# ?/?", "3"), ("0.3333", "# ?/?", "1/3"), ("1.75", "?/?", "7/4"), ("0.125", "# ??/??", "1/8"), ("2.5", "# ?/8", "2 4/8"),
    ("1234567", "#,##0,.0", "1,234.6"), ("1500", "0,.00", "1.50"), ("7.5", "??0.0?", "  7.5 "),
]


@pytest.mark.parametrize(("text", "code", "want"), CASES)
def test_numbers_as_shown(text, code, want):
    assert shown_number(text, code).strip() == want.strip()
    if "?" not in code:
        assert shown_number(text, code) == want


def test_built_in_formats_all_show_something():
    assert all(shown_number("1234.5", code) for code in BUILT_IN.values())


def test_reader_shows_numbers(spark, tmp_path):
    from test_profiler import write_xlsx

    from colscope.sources.xlsx import XlsxSource, read_workbooks

    write_xlsx(tmp_path / "a.xlsx", [["n", "p", "d"], [(1, 1234.5), (2, 0.256), (3, 45000)], ["7", "x", (1, -2)]], styles=[0, "#,##0.00;(#,##0.00)", 9, 14])
    spark.dataSource.register(XlsxSource)
    read = lambda **o: [tuple(r)[1:] for r in spark.read.format("xlsx").options(**o).load(str(tmp_path / "a.xlsx")).orderBy("_row").collect()]
    assert read(displayed="true") == [("1,234.50", "26%", "2023-03-15T00:00:00.000Z"), ("7", "x", "(2.00)")]
    assert read() == [("1234.5", "0.256", "2023-03-15T00:00:00.000Z"), ("7", "x", "-2")]
    assert [r.cells["n"] for r in read_workbooks(spark, str(tmp_path), displayed=True).orderBy("row").collect()] == ["1,234.50", "7"]
