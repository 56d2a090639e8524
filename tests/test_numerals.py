"""CJK numerals in text metrics, and what they cost."""

import unicodedata

from pyspark.sql import functions as F

from sheafworks.functions import text as X


def test_numerals_are_looked_up(spark):
    texts = ["", "abc 12", "一二三 and 12½", "百\U00020001\U00022390\U00020AEA x", "漢字かな交じり文 七", "٣ Ⅷ 〇 四四", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [None if t is None else sum(unicodedata.category(c)[0] == "N" or c.isnumeric() for c in t) for t in texts]
    count = X.metrics(F.col("t"))["numeric_chars_count"]
    assert [r.n for r in rows.select(count.alias("n")).collect()] == want
    assert "x{4E00}" not in str(count)  # no class that every character is compared with, letter by letter
