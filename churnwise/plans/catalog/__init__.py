"""Registered queries, grouped by SURVEY §2 section."""

from . import core  # noqa: F401
from . import eda  # noqa: F401
from . import evaluation  # noqa: F401
from . import decisions  # noqa: F401
from . import whatif  # noqa: F401
from . import store  # noqa: F401
from . import ml  # noqa: F401
from . import streaming  # noqa: F401
from . import text  # noqa: F401
from . import quality_io  # noqa: F401
from . import extras  # noqa: F401
