import math

from vela.functions.stats import binom_sf, chi2_sf, clopper_pearson


def test_clopper_pearson_matches_published_interval():
    # LDA on the biopsy test rows: 134 of 139 right; interval (0.9181, 0.9882)
    lo, hi = clopper_pearson(134, 139)
    assert round(lo, 4) == 0.9181 and round(hi, 4) == 0.9882


def test_binomial_and_chi_square_tails():
    assert abs(binom_sf(3, 10, 0.5) - 0.9453125) < 1e-12
    assert abs(chi2_sf(3.2, 1) - 0.07364) < 1e-5            # McNemar p of the same table
    assert abs(chi2_sf(6.0, 3) - 0.1116102) < 1e-6
    assert binom_sf(134, 139, 91 / 139) < 2e-16
