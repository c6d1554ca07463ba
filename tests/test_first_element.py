"""The first div of a page against a plain tag stack."""

import random
import re

from pyspark.sql import functions as F

from hazardlake.functions import html as H


def plain_first_div(page):
    page = re.sub(r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ", page)
    start, depth = None, 0
    for m in re.finditer(r"(?i)<(/?)div(?=[\s/>])[^>]*>", page):
        if start is None:
            if not m[1]:
                start, depth = m.end(), 1
        else:
            depth += -1 if m[1] else 1
            if depth == 0:
                return page[start:m.start()]
    return None if start is None else page[start:]


def test_random_nested_pages(spark):
    rng = random.Random(1)
    bits = ["<div>", "<DIV class='a'>", "<div\n id=x>", "</div>", "</div >", "<p>one", "</p>", "<p>two</p>", "text ", "<divider>", "<!-- <div> -->",
            "<script>'</div>'</script>", "<section>", "</section>", "<div/>"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    pages += ["", "<div>", "</div>", "<div></div>", "<div>a<div>b</div>c</div>d", "<div>" * 3000 + "x" + "</div>" * 3000 + "y"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)] + [(-1, None)], "i int, html string")
    got = {r.i: r.t for r in df.select("i", H.first_element(F.col("html")).alias("t")).collect()}
    assert got.pop(-1) is None
    assert got == {i: plain_first_div(p) for i, p in enumerate(pages)}


def test_paragraphs_of_the_first_div(spark):
    page = "<p>out</p><div><p>A<p>B <div><p>C</div> tail</p><p>D</div><p>E</p>"
    df = spark.createDataFrame([(page,)], "html string")
    got = df.select(H.paragraphs(H.first_element(F.col("html"))).alias("p")).first().p
    assert got == ["A", "B", "C", "D"]
