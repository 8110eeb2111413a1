"""General interfaces called from another folder, with workers that do not find the repository."""

import os
import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[2])

CODE = """
import sys
sys.path.insert(0, {repo!r})
from ledgerlake.session import get_spark
spark = get_spark("local[2]", shuffle_partitions=2)
from ledgerlake.llm import decontamination, html_extract, nearest, secret_scan
docs = spark.createDataFrame([(k, "password = abcdefgh12345678 and five more words %d" % k, "en") for k in range(6)], "doc_id long, text string, lang string")
vectors = spark.createDataFrame([(k, [float(k)] * 64) for k in range(6)], "vec_id long, embedding array<double>")
pages = spark.createDataFrame([(1, "http://h/a", "<article><p>text</p></article>")], "page_id long, url string, html string")
items = spark.createDataFrame([(1, "five more words")], "item_id long, text string")
for df in {calls}:
    assert df.collect(), df
print("all ran")
"""

CALLS = ["secret_scan.scan(docs)", "html_extract.extract(pages)", "nearest.nearest(vectors, vectors)", "decontamination.decontaminate(docs, items)"]


def test_operators_ship_the_package(tmp_path):
    """Each call comes first in a session of its own, so none lives on what another sent."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for call in CALLS:
        done = subprocess.run([sys.executable, "-c", CODE.format(repo=REPO, calls=f"[{call}]")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
        assert "all ran" in done.stdout, (call, done.stderr[-2000:])
