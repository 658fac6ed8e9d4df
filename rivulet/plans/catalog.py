"""Imports every catalog module so that their queries register."""

from . import catalog_clean  # noqa: F401
from . import catalog_model  # noqa: F401
from . import catalog_text  # noqa: F401
from . import catalog_io  # noqa: F401
from . import catalog_stream  # noqa: F401
from . import catalog_learn  # noqa: F401
from . import catalog_train  # noqa: F401
from . import catalog_artefact  # noqa: F401
from . import catalog_flows  # noqa: F401
