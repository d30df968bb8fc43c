"""Operations-telemetry analytics as Spark DataFrame operators.

Column names follow the monitoring data set (``RECON_ID``, ``CORE_TIME_NUM`` ...).
"""

from opstelemetry.config import Config, configure

__all__ = ["Config", "configure"]
