"""Executors need no copy of the package: every query runs where workers cannot import it."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__
from sedgemill.session import build_session
spark = build_session("local[2]", 2, "2g")
probe = spark.range(1).mapInArrow(lambda b: (x for x in b if __import__("importlib.util").util.find_spec("sedgemill") is None), "id long")
assert probe.count() == 1, "workers see the package"
for name, plan in __spark_entry__.queries().items():
    if name == "pipeline" or name.startswith("op"):
        print("RAN", name, plan(spark, sys.argv[2]).count(), flush=True)
"""


def test_queries_run_without_the_package_on_the_workers(spark, frame, corpus, tmp_path):
    data = tmp_path / "data"
    texts = [(n, t) for n, (_, t) in enumerate(corpus) if len(t or "") < 3000][:40]
    frame(texts).withColumnRenamed("key", "source").drop("_key", "words").write.parquet(str(data / "documents.parquet"))
    tables = {
        "labels": ("doc_id long, quality int, toxic int", [(i, i % 2, 0) for i, _ in texts]),
        "benchmark": ("item_id long, text string", [(1, texts[0][1]), (2, "How many apples does Tom have if he buys 7 of them today?")]),
        "pages": ("page_id long, url string, html string", [(i, f"https://site{i % 3}.example.com/en/a{i}", "<p>some words here</p>") for i in range(12)]),
        "conversations": ("conv_id long, turn long, role string, text string", [(i // 4, i % 4, ("user", "assistant")[i % 2], f"Say {i}.") for i in range(40)]),
        "embeddings": ("vec_id long, embedding array<float>, label int", [(i, [float(i % 7), float(i * i % 11), 1.0 * i], 0) for i in range(30)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(data / f"{name}.parquet"))
    script = tmp_path / "elsewhere" / "run.py"
    script.parent.mkdir()
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    extra = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and not Path(p).resolve().is_relative_to(REPO)]
    env["PYTHONPATH"] = ":".join(extra)
    ran = subprocess.run([sys.executable, str(script), str(REPO), str(data)], cwd=script.parent, env=env, capture_output=True, text=True, timeout=900)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert ran.stdout.count("RAN") == 14
