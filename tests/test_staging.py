import os
from types import SimpleNamespace

import pytest

from taxaflow.functions import staging


def test_staged_tables_have_a_run_folder(spark):
    table = staging.materialize(spark.range(3), "three")
    path = table.inputFiles()[0].removeprefix("file://")
    assert staging.run_dir(spark).removeprefix("file:").lstrip("/") in path and table.count() == 3
    staging.clean_run(spark)
    assert not os.path.exists(path)


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        spark = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master))
        with pytest.raises(ValueError):
            staging.shared_dir(spark)
