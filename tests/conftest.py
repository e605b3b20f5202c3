import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "plumbline-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.default.parallelism": "2",
            # Thousands of tiny plans: compiling each would cost more than running it.
            "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
