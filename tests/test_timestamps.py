from datetime import datetime

from pyspark.sql import functions as F

from moodlake.functions.timestamps import iso_text, iso_timestamp, normalise_timestamp, parse_timestamp

D = datetime
CASES = {
    "Mon Apr 06 22:19:45 PDT 2009": D(2009, 4, 7, 5, 19, 45),
    "Mon Nov 02 01:30:00 PST 2009": D(2009, 11, 2, 9, 30),
    "mon apr 6 2:19:45 utc 2009": D(2009, 4, 6, 2, 19, 45),
    "Mon Apr 06 22:19:45 CET 2009": D(2009, 4, 6, 20, 19, 45),
    "Mon Apr 06 22:19:45 -0700 2009": D(2009, 4, 7, 5, 19, 45),
    "Mon Apr 06 22:19:45 -07:00 2009": D(2009, 4, 7, 5, 19, 45),
    "Mon Apr 06 22:19:45 Z 2009": D(2009, 4, 6, 22, 19, 45),
    "2024-01-02T03:04:05Z": D(2024, 1, 2, 3, 4, 5),
    "2024-01-02T03:04:05+05:00": D(2024, 1, 1, 22, 4, 5),
    "2024-01-02T03:04:05+0500": D(2024, 1, 1, 22, 4, 5),
    "2024-01-02T03:04:05.123Z": D(2024, 1, 2, 3, 4, 5, 123000),
    "2024-01-02T03:04:05.000007+0000": D(2024, 1, 2, 3, 4, 5, 7),
    "2024-01-02 03:04:05": D(2024, 1, 2, 3, 4, 5),
    "  2024-1-2   3:4:5\n": D(2024, 1, 2, 3, 4, 5),
    "13/01/2024 03:04:05": D(2024, 1, 13, 3, 4, 5),
    "01/13/2024 03:04:05": D(2024, 1, 13, 3, 4, 5),
    "02/03/2024 03:04:05": D(2024, 3, 2, 3, 4, 5),
    "12/12/2024 3:4:5": D(2024, 12, 12, 3, 4, 5),
    "12/31/2024 03:04:05": D(2024, 12, 31, 3, 4, 5),
    "31/12/2024 03:04:05": D(2024, 12, 31, 3, 4, 5),
    "02/30/2024 03:04:05": None,
    "13/13/2024 03:04:05": None,
    "31/02/2024 03:04:05": None,
    "2024-02-30 03:04:05": None,
    "Apr 06 22:19:45 PDT 2009": None,
    "Mon Apr 06 22:19:45 XQZ 2009": None,
    "2024-01-02T03:04:05": None,
    "garbage": None,
    "": None,
    "  ": None,
    None: None,
}


def test_formats(evaluate):
    got = dict(zip(CASES, evaluate(lambda c: F.date_format(parse_timestamp(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"), list(CASES))))
    assert got == {k: v and v.strftime("%Y-%m-%d %H:%M:%S.%f") for k, v in CASES.items()}


def test_every_slashed_date_reads_as_by_trying_both_orders(evaluate):
    """Against the plain rule: day first if that is a date, else month first."""
    pairs = [(a, b) for a in range(0, 33) for b in range(0, 33)]

    def by_rule(a, b):
        for day, month in ((a, b), (b, a)):
            try:
                return D(2024, month, day, 1, 2, 3).strftime("%Y-%m-%d")
            except ValueError:
                pass

    got = evaluate(
        lambda c: F.date_format(parse_timestamp(c), "yyyy-MM-dd"), [f"{a:02d}/{b}/2024 1:02:3" for a, b in pairs]
    )
    assert got == [by_rule(a, b) for a, b in pairs]


def test_default(evaluate):
    fixed = F.lit("2000-01-01 00:00:00").cast("timestamp")
    out = evaluate(lambda c: iso_text(normalise_timestamp(c, fixed)), ["garbage", "2024-01-02T03:04:05.5Z"])
    assert out == ["2000-01-01T00:00:00+00:00", "2024-01-02T03:04:05.500000+00:00"]


def test_bad_iso_text_is_null_under_ansi(spark, evaluate):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    out = evaluate(lambda c: iso_text(iso_timestamp(c)), ["2024-01-02T03:04:05+00:00", "no", None])
    assert out == ["2024-01-02T03:04:05+00:00", None, None]
