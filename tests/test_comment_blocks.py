"""Comment blocks of nested markup against a plain scan with a counter, and on long pages."""

import random
import re
import time

from tarmac.operators import pages


def plain(html):
    out, depth, text = [], 0, ""
    for piece in re.split(r"(?=<div\b)|(?=</div>)", html or ""):
        opens, closes = re.match(r"<div\b", piece), piece.startswith("</div>")
        if depth == 0:
            if re.match(r'<div class="content"[^>]*>', piece):
                depth, text = 1, piece
            continue
        depth += 1 if opens else -1 if closes else 0
        if depth == 0:
            out.append(text)
        else:
            text += piece
    return [re.sub("<[^>]+>", "", t).replace(",", " ").strip(" ") for t in out]


def random_page(rng, depth=0):
    parts = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.random()
        if kind < 0.4:
            parts.append(rng.choice(["a, b", " <b>bold</b> ", "x\ny", "</div>" if rng.random() < 0.1 else "&amp;"]))
        elif depth < 5:
            tag = rng.choice(['<div class="content">', '<div class="content" id="1">', "<div>", '<div class="other">', "<divider>"])
            parts.append(tag + random_page(rng, depth + 1) + ("</div>" if rng.random() < 0.95 and tag != "<divider>" else ""))
    return "".join(parts)


def test_nested_blocks(spark):
    rng = random.Random(3)
    rows = [(f"http://h/{i}", random_page(rng)) for i in range(400)] + [("http://h/e", ""), ("http://h/n", None)]
    got = pages.extract_comments(spark.createDataFrame(rows, "url string, html string").repartition(4)).collect()
    want = [(c, u.rsplit("/", 1)[1]) for u, h in rows for c in plain(h)]
    assert len(want) > 100 and sorted((r.comment, r.airport) for r in got) == sorted(want)


def test_long_pages_take_time_in_proportion(spark):
    def seconds(n):
        html = '<div class="content">' + "".join(f"<div>part {i}</div>" for i in range(n)) + "</div>"
        df = spark.createDataFrame([("u/x", html)], "url string, html string")
        t = time.time()
        assert len(pages.extract_comments(df).first().comment) > 5 * n
        return time.time() - t

    seconds(1000)
    assert seconds(60_000) < 20  # text grown piece by piece: about 30 GB of copies
