"""News-event and social-media analytics as Spark DataFrame operators."""

from tidewatch.session import CLUSTER_CONF, CORE_CONF, build_session

__all__ = ["CLUSTER_CONF", "CORE_CONF", "build_session"]
