import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", 4,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def contact_rows():
    """Hand-made contacts: three jobs, both classes, sentinels and extremes."""
    rows = []
    for i in range(240):
        rows.append(
            (
                20 + i % 50,
                ["clerk", "blue-collar", "self-employed"][i % 3],
                ["single", "married"][i % 2],
                ["primary", "secondary", "tertiary", "unknown"][i % 4],
                "yes" if i % 40 == 0 else "no",
                (i * 37) % 500 - 100,
                "yes" if i % 3 else "no",
                "yes" if i % 5 == 0 else "no",
                ["cellular", "telephone", "unknown"][i % 3],
                1 + i % 28,
                ["jan", "may", "jul", "dec"][(i // 2) % 4],
                10 + (i * 13) % 300 + (400 if i % 8 == 0 else 0),
                1 + i % 4,
                -1 if i % 2 else i % 90,
                0 if i % 2 else 1 + i % 3,
                "unknown" if i % 2 else ["failure", "success", "other"][i % 3],
                "yes" if i % 8 == 0 or i % 31 == 0 else "no",
            )
        )
    return rows


@pytest.fixture(scope="session")
def contacts(spark, contact_rows):
    from tidemark.sources.schemas import CONTACT_SCHEMA

    return spark.createDataFrame(contact_rows, CONTACT_SCHEMA).cache()
