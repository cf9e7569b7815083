"""callsheet: contact-list ("mailing") generation for collection campaigns on Spark.

Every step is a DataFrame -> DataFrame function built from Spark's own
expressions.  Nothing is collected to the driver; portfolios and campaigns are
keys carried through the plan, so one job serves all of them.
"""

from callsheet.plans.mailings import (  # noqa: F401
    MailingParams,
    mailing,
    mailing_batch,
    mailing_counts,
)
from callsheet.sources.tables import load_tables  # noqa: F401
