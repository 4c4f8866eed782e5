"""Operators run on workers that cannot import the package."""

import os
import subprocess
import sys
import textwrap

import pytest

pytest.importorskip("tessera.llm.queries")

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_a_scorer_reaches_workers_by_value(tmp_path):
    job = tmp_path / "job.py"
    job.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})   # the driver alone
        from tessera.session import build_session
        from tessera.llm.toxicity import toxicity, without_toxic
        spark = build_session("local[2]", "foreign", 2)
        rows = [(i, "you utter idi0t " * 3 if i % 4 == 0 else "a calm and friendly text about boats") for i in range(200)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
        got = toxicity(docs, labels).collect()
        assert {{r.doc_id for r in got if r.predicted}} == set(range(0, 200, 4)), got[:5]
        assert without_toxic(docs, labels).count() == 150
        print("right")
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(job)], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=300)
    assert done.stdout.strip().endswith("right"), done.stderr[-2000:]
