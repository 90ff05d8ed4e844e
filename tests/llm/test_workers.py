"""What runs in Python workers can be read back where the library is not installed."""

import subprocess
import sys

from pyspark import cloudpickle

from dailywire.llm import audit, manifest, minhash, packing, prefix_join, substring, toxicity, verify, workers


def test_worker_functions_travel_by_value(tmp_path):
    functions = [
        minhash._sketches(5, 80), minhash._candidates(80), verify._confirmed(5, 80), prefix_join._count(5), prefix_join._prefixed(5, 80, None), prefix_join._tokens, prefix_join._recurring,
        prefix_join._candidates(80), audit._popcounts, manifest._reduce, manifest._prove(True), toxicity._feature_rows, packing.Encoder, substring._first_of,
    ]
    functions += [workers.giving_back(f) for f in functions[:1]] + [workers.giving_back(lambda table: table), workers.giving_back(lambda left, right: left)]
    (tmp_path / "functions").write_bytes(cloudpickle.dumps(functions))
    code = f"import sys; sys.modules['dailywire'] = None; from pyspark import cloudpickle; print(len(cloudpickle.loads(open({str(tmp_path / 'functions')!r}, 'rb').read())))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, check=False)
    assert out.stdout.strip() == str(len(functions)), out.stderr[-2000:]
