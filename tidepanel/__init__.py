"""tidepanel: panel-table analytics on Spark DataFrames.

Every operator takes a DataFrame and returns a lazy DataFrame. Fitted
statistics (one row, bounded level lists, model parameters) are the only
things that ever reach the driver.
"""

from tidepanel.spec import PanelSpec

__all__ = ["PanelSpec"]
__version__ = "0.1.0"
