import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from presslake.session import get_spark
    s = get_spark("local[4]", 8, app_name="presslake-tests",
                  extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
