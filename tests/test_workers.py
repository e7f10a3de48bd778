import subprocess
import sys
import textwrap

from helpers import ROOT


def test_python_stages_run_from_another_directory(tmp_path):
    # Python workers must import the package even when the driver's working
    # directory is not the repository (the package is shipped with addPyFile).
    (tmp_path / "t.txt").write_text("junk\na|b\n1|x\n2|y\n")
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        from quarry.session import ship_package
        from quarry.sources.text import read_text
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        df = read_text(spark, {str(tmp_path / "t.txt")!r}, delimiter="|", skip_rows=1)
        print(sorted(tuple(r) for r in df.collect()))
        spark.stop()
    """)
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), capture_output=True, text=True,
                         timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "[(1, 'x'), (2, 'y')]" in out.stdout
