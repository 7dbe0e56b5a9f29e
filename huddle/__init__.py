"""huddle: a Spark-native batch pipeline for club, team, event and RSVP data.

Layers (raw -> clean -> dims/facts -> metrics) are plain ``DataFrame -> DataFrame``
functions; only ``operators.sinks`` and ``sources`` touch files, catalogs or JDBC.
"""

from huddle.config import JobConfig

__all__ = ["JobConfig"]
