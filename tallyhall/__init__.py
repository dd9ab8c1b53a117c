"""tallyhall: Spark-native event-attendance analytics.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function so Catalyst sees one declarative plan end to end.
"""

__version__ = "0.1.0"
