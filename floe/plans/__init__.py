"""User jobs composed from the operators; each stays one lazy DataFrame plan."""
