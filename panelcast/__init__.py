"""panelcast: mixed-frequency panel forecasting on Spark DataFrames.

Long panels (entity x indicator x month, entity x target x quarter) are
built, transformed, aligned, split, modelled and scored with DataFrame,
window and Spark ML code only.
"""

from panelcast.params import Params, TEST_PARAMS

__all__ = ["Params", "TEST_PARAMS"]
