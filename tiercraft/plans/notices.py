"""Alert notices and access rights."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tiercraft.functions.columns import nonempty, project, quoted
from tiercraft.operators.dedupe import keep_one
from tiercraft.operators.filters import required
from tiercraft.plans import layouts


def alerts_silver(bronze: DataFrame) -> DataFrame:
    """One row per notification id, the last loaded one."""
    rows = project(bronze, layouts.ALERTS_SILVER).filter(nonempty(quoted("dynamic_alerts_notification_id")))
    newest = quoted("dynamic_alerts_execution_date").desc_nulls_last()
    return keep_one(rows, [quoted("dynamic_alerts_notification_id")], [newest])


def alerts_gold(silver: DataFrame) -> DataFrame:
    return keep_one(required(project(silver, layouts.ALERTS_GOLD), "NotificationID"), [quoted("NotificationID")])


def security_silver(bronze: DataFrame) -> DataFrame:
    """Rows with an e-mail, repeated ones included; the text NULL is kept as it came."""
    return required(project(bronze, layouts.SECURITY_SILVER), "security_email")


def security_gold(silver: DataFrame) -> DataFrame:
    return project(silver, layouts.SECURITY_GOLD)
