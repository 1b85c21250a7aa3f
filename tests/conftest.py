import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eavflow.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # the shared folder that a cluster would name
    shared = tmp_path_factory.mktemp("shared")
    s = get_session(master="local[*]", shuffle_partitions=8, extra={"spark.checkpoint.dir": f"file://{shared}"})
    yield s


EAV_SCHEMA = ("src string, ord long, filename string, yearend string, entityid string, "
              "entityname string, bundleguid string, lastmodified string, cwguid string, "
              "form string, group_ string, id string, data string")


def eav(spark, rows, src="f"):
    """Literal EAV rows: (form, group_, id, data); ord = position, header from ord."""
    full = [(src, i, f"{src}.csv", "2020", "7", "E", "b", str(i), "c", f, g, k, d)
            for i, (f, g, k, d) in enumerate(rows)]
    return spark.createDataFrame(full, EAV_SCHEMA)
