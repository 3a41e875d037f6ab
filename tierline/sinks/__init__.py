"""Published layers: whole versions behind one pointer."""
