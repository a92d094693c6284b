"""urbanpulse: a Spark-native batch engine that turns city open data into a
neighbourhood change index (raw landing -> processed tables -> indicators ->
z-score / min-max -> composite index), expressed as DataFrame/SQL plans."""

__version__ = "0.1.0"
