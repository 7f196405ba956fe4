import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pkgsync.session import checkpoint_root, local_session

    s = local_session(4, 8, app="pkgsync-tests")
    checkpoint_root(s)  # unset in tests -> a fresh folder under /tmp
    yield s
    s.stop()
