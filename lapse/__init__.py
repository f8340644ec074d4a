"""lapse: customer-inactivity analytics as Spark DataFrame plans.

Every operator takes DataFrames (and column names / bounds) and returns a
DataFrame.  Nothing collects to the driver; the caller decides the action.
"""

from lapse.config import StudyWindow

__all__ = ["StudyWindow"]
