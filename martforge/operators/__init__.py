"""DataFrame -> DataFrame operators.  None of them triggers an action."""
