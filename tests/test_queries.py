"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as driver
import oracle_queries
from clickweave.operators import grid, hashed
from tests.compare import connect, difference

SF_DIR = driver.SMOKE_DIR
OWN = driver._own_queries()
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(OWN)
    assert set(driver.oracle_sql()) <= set(driver.queries())


# the report runs the grid search too
@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"grid_search"}))
def test_query(spark, connection, name):
    assert difference(OWN[name](spark, SF_DIR), connection, ORACLES[name], digits=5) is None


def test_grid_search_with_few_iterations(spark, connection):
    """The query itself takes minutes in SQL; its steps are the same."""
    encoded = driver._hashed(spark, SF_DIR)
    train, validation = driver._of(encoded, "train"), driver._of(encoded, "validation")
    _, cells = grid.grid_search(train, validation, hashed.NUM_BUCKETS, iterations=12)
    sql = oracle_queries.search(
        """SELECT CAST(model_id AS INTEGER) AS grid_order, step AS step_size, reg AS reg_param, log_loss
FROM losses WHERE split = 'validation'""",
        iterations=12,
    )
    assert difference(cells, connection, sql, digits=7) is None
