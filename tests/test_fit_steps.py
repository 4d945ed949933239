"""The fit's steps: they end where digits end, and many rows are not begun at zero."""

import pytest

from lendlake.operators import model


@pytest.fixture(scope="module")
def rows(spark):
    noise = "(hash(id) % 1000) / 1000.0D"
    return spark.range(4000).selectExpr(
        "cast(id % 97 as double) as a", f"{noise} as b", "if(id % 3 = 0, 'x', 'y') as kind", f"(id % 97) / 97.0D + {noise} > 0.4D as y"
    ).repartition(4)


def test_steps_end_at_the_last_digit(rows):
    """A tolerance that rounding can't meet, as that of very many rows: steps end, and the fit is the same."""
    fitted = model.fit_default_model(rows, ["a", "b"], ["kind"], "y", tol=0.0)
    plain = model.fit_default_model(rows, ["a", "b"], ["kind"], "y")
    assert fitted.steps < 30
    assert fitted.coefficients == pytest.approx(plain.coefficients, abs=1e-7)


def test_a_start_from_a_share_ends_at_the_same_place(rows, monkeypatch):
    plain = model.fit_default_model(rows, ["a", "b"], ["kind"], "y")
    monkeypatch.setattr(model, "START_ROWS", 1)
    monkeypatch.setattr(model, "START_SHARE", 4)
    fitted = model.fit_default_model(rows, ["a", "b"], ["kind"], "y")
    assert fitted.coefficients == pytest.approx(plain.coefficients, abs=1e-7)
    assert fitted.steps < plain.steps and fitted.gradient <= 1e-7
